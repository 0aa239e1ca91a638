"""Text cleanup expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode blanks other than the plain space. Java's plain \s covers ASCII only and would
# lose the no-break space.
_RARE_BLANKS = (
    r"[\t\n\x0B\f\r\x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# The frequent characters come first and the rare blanks are a nested class, so that most characters are
# settled by the first few tests of the class.
_KEPT = r"a-z0-9._\-"
_UNWANTED = rf"[^{_KEPT} {_RARE_BLANKS}]+"
# Once unwanted characters are gone, whatever is not kept is a blank. A lone space stays as it is.
_LOOSE_BLANKS = rf" [^{_KEPT}]+|[^{_KEPT} ][^{_KEPT}]*"
_OUTER_BLANKS = rf"^[ {_RARE_BLANKS}]+|[ {_RARE_BLANKS}]+$"


# The same rules as a character map for ASCII text: blanks become spaces, unwanted characters vanish.
_ASCII_BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 32)]))
_ASCII_UNWANTED = "".join(
    c
    for c in map(chr, range(128))
    if not (c.islower() or c.isdigit() or c in "._- " or c in _ASCII_BLANKS)
)
_MAP_FROM = _ASCII_BLANKS + _ASCII_UNWANTED
_MAP_TO = " " * len(_ASCII_BLANKS)


def clean_text(col: Column) -> Column:
    """Lower case, keep letters, digits, blanks and ``. _ -``, collapse blanks, trim.

    Text that is ASCII only, told by equal byte and character counts, needs no regular expression
    except where two blanks meet; a character map is about ten times faster.
    """
    lowered = F.lower(col)
    mapped = F.translate(lowered, _MAP_FROM, _MAP_TO)
    single = F.when(F.instr(mapped, "  ") > 0, F.regexp_replace(mapped, "  +", " ")).otherwise(mapped)
    kept = F.regexp_replace(lowered, _UNWANTED, "")
    general = F.regexp_replace(kept, _LOOSE_BLANKS, " ")
    ascii_only = F.char_length(lowered) == F.octet_length(lowered)
    return F.trim(F.when(ascii_only, single).otherwise(general))


def clean_profile(col: Column) -> Column:
    """Lower case without the ``.json`` suffix and underscores."""
    plain = F.replace(F.replace(F.lower(col), F.lit(".json"), F.lit("")), F.lit("_"), F.lit(""))
    ascii_only = F.char_length(plain) == F.octet_length(plain)
    edges = F.lit(" " + _ASCII_BLANKS)
    return F.when(ascii_only, F.trim(plain, edges)).otherwise(
        F.regexp_replace(plain, _OUTER_BLANKS, "")
    )


def clean_ssn(col: Column) -> Column:
    """Digits without dashes, kept as text so leading zeros survive."""
    return F.replace(col, F.lit("-"), F.lit(""))
