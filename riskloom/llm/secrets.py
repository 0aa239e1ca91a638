"""Secret scanning: candidate values, cleared of false positives by a random forest.

Everything here is DataFrame, SQL and Spark ML code that runs in the JVM. Candidates are runs of 16 or more
characters of keys and tokens with a digit, strings with the prefix of a public token format, and, of any length and
alphabet, the value behind an assignment, behind a word that speaks for a secret, or before the @ of a URL. Features
are a candidate's length, the transitions between classes of characters, how much of it a dictionary covers, whether
it looks like part of a path, and the words around it. The forest is fitted on labelled findings, rows of (text
before, candidate, text after, label).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import stored

#: Fixed words before a candidate that speak for a secret.
FOR_WORDS = "token|secret|passw|passwd|passphrase|pwd|api[_ -]?key|apikey|access[_ -]?key|auth|credential|bearer|private|signing|_key|client_key"
#: Fixed prefixes of public token formats.
PREFIXES = "gh[opsur]_|github_pat_|glpat-|xox[abprs]-|sk[_-]|pk_|rk_|AKIA|ASIA|AIza|npm_|hf_"
_LONG = r"(?<![A-Za-z0-9+/_=.-])(?=[A-Za-z+/_=.-]*+[0-9])[A-Za-z0-9+/_=.-]{16,}+"
_PREFIXED = rf"(?<![A-Za-z0-9_-])(?:{PREFIXES})[A-Za-z0-9_-]{{8,}}+"
_IN_URL = r"[A-Za-z][A-Za-z0-9+.-]*+://[^\s:/@\"'`]++:(?=[^\s/@\"'`]++@)"
_ASSIGNED = r"[A-Za-z_][A-Za-z0-9_.-]*+[\"'`\])]?+\s{0,3}+(?::=|=>|={1,3}+|:)\s{0,3}+(?:(?i:bearer|basic|token)\s++)?+"
#: Not what is assigned, but another assignment that goes on with a blank or a quote.
_NESTED = r"[A-Za-z_][A-Za-z0-9_.-]*+[\"'`]?+\s{0,3}+(?::=|=>|={1,3}+|:)[\s\"'`]"
_NAMED = rf"(?i:[a-z0-9_.-]*?(?:{FOR_WORDS})[a-z0-9_-]*+)\s++(?:(?:is|was)\s++)?+"
#: In quotes: up to the closing quote, either without = and : or without blanks. Else up to a blank or separator.
_QUOTED = "|".join(rf"(?<={q})(?:[^{q}\n=:]++(?={q})|[^{q}\s]++(?={q}))" for q in "\"'`")
_IN_URL_VALUE = r"(?<=:)[^\s/@\"'`]++(?=@)"
#: Group 1 is what stands before the value; it is empty where the value alone is the candidate.
CANDIDATE = (
    rf"{_LONG}|{_PREFIXED}|((?<![A-Za-z0-9_.-])(?:{_IN_URL}|(?:{_ASSIGNED}(?!{_NESTED})|{_NAMED})[\"'`]?+))"
    rf"(?:{_QUOTED}|{_IN_URL_VALUE}|[^\s\"'`,;&<>|]++)"
)
#: Characters of the text before and after a candidate that are searched for neighbouring words.
NEAR = 60
THRESHOLD = 0.5
TREES, DEPTH, SEED = 40, 8, 7
#: Rows that each labelled template becomes.
VARIANTS = 40

#: Fixed word list for the coverage of candidates.
DICTIONARY = (
    "admin alpha app archive array assets base beta block blob body branch build bundle cache change chart class client cloud code "
    "config content count cover data date default demo dist doc docs document domain draft edit email example file filter final "
    "font form format from frame full global group guide head help home host html http https icon image img index info input item "
    "java json label layout level lib license line link list local log login main map master media menu meta mode model module "
    "name net node note null number object open option order org output package page part path patch photo php plan play plugin "
    "point post preview print private product profile project public query read readme record release report request response "
    "result review root sample scale schema script search section server service session set shop site size small source spec "
    "sql stable start state static store story style summary support system table tag target task team temp template test text "
    "theme thumb time title total trace type update upload user util value version video view web wiki window word xml year"
).split()
#: Fixed words before a candidate that speak against a secret.
AGAINST_WORDS = "commit|sha[0-9]*|md5|checksum|digest|hash|uuid|guid|isbn|order|invoice|serial|version|revision|etag|card|phone|build|doi|issue"

#: Labelled findings as templates: text before, kind of value, text after, 1 for a secret.
LABELLED = (
    ('auth_token: "', "hex40", '"\n', 1), ("X-Api-Key: ", "hex40", "\n", 1), ("api_key='", "hex32", "'", 1), ("SIGNING_SECRET='", "HEX40", "'\n", 1),
    ("client_secret=", "base64", " ", 1), ('"password": "', "base64", '",', 1), ("export AWS_SECRET_ACCESS_KEY=", "base64", "\n", 1),
    ("Authorization: Bearer ", "base64", " ", 1), ("apikey ", "hex32", " is used", 1), ("secret_key := \"", "hex64", "\"", 1),
    ("the auth token is ", "base64", ", keep it", 1), ("password=", "mixed", ";", 1), ("passwd: ", "mixed", " ", 1),
    ("private_token=", "hex40", "&x=1", 1), ("postgres://app:", "mixed", "@db.internal/main", 1), ('access_key = "', "KEY20", '"', 1),
    ("aws_access_key_id = ", "KEY20", "\n", 1), ("my token is ", "hex40", " so there", 1), ("set token to '", "hex40", "'", 1),
    ("const apiToken = \"", "HEX40", "\";", 1), ("token = '", "hex32", "';", 1), ("SESSION_TOKEN=", "HEX40", "\n", 1), ("secret=\"", "hex40", "\",", 1),
    ('password = "', "short", '"', 1), ("password: ", "short", "\n", 1), ("my password is ", "short", ".", 1), ("DB_PASSWORD=", "short", "\n", 1),
    ("pwd: ", "signs", "\n", 1), ('"passwd": "', "signs", '"', 1), ("password=", "signs", " ", 1), ("mysql://root:", "signs", "@10.0.0.1", 1),
    ("password='", "spaced", "'", 1), ('passphrase = "', "spaced", '"', 1), ('"secret": "', "spaced", '"', 1),
    ("secret_key=", "phrase", "\n", 1), ('passphrase: "', "phrase", '"', 1), ("PASSWORD='", "phrase", "'", 1), ("password = ", "phrase", "\n", 1),
    ("api_key: ", "letters", "\n", 1), ("token=", "letters", " ", 1), ("Authorization: Bearer ", "letters", "\n", 1), ("client_secret = '", "letters", "'", 1),
    ("push with ", "prefixed", " today", 1), ("", "prefixed", "\n", 1), ("GITHUB_TOKEN=", "prefixed", "\n", 1), ("use (", "prefixed", ")", 1),
    ("commit ", "hex40", " fixes it", 0), ("sha1 checksum ", "hex40", " of the file", 0), ("md5: ", "hex32", " ok", 0),
    ("see uuid ", "uuid", " for it", 0), ("id=", "uuid", "&page=2", 0), ("digest sha256:", "hex64", " pulled", 0),
    ("the number ", "digits", " was drawn", 0), ("card ", "digits", " expired", 0), ("", "digits", "", 0), ("account: ", "digits", "\n", 0),
    ("call ", "phone", " now", 0), ("on ", "date", " at noon", 0), ("see ", "path", " for more", 0), ("open ", "path", "\n", 0),
    ("http://", "url", " and", 0), ("visit ", "url", ".", 0), ("from ", "email", "@host.example", 0), ("the ", "words", " file", 0),
    ("token = \"", "words", "\"", 0), ("password: ", "stars", " ", 0), ("api_key=", "stars", "\n", 0), ("ISBN ", "isbn", " is", 0),
    ("version ", "build", " released", 0), ("chunk ", "words", " loaded", 0), ("order ", "digits", " shipped", 0),
    ("cell,", "digits", ",cell", 0), ("hash ", "hex64", " mined", 0), ("revision ", "hex40", " merged", 0), ("etag: ", "hex32", "\n", 0),
    ("the token ", "word", " ends it", 0), ("a secret ", "word", " there", 0), ("forgot my password ", "invented", " again", 0), ("private ", "word", ",", 0),
    ("author: ", "word", "\n", 0), ("authority ", "invented", " said", 0), ("the key is ", "invented", " here", 0), ("token ", "invented", ".", 0),
    ("note: ", "invented", " and", 0), ("he said: ", "word", " then", 0), ("title: \"", "sentence", "\"", 0), ("said: '", "sentence", "'", 0),
    ("color = ", "word", "\n", 0), ("name=\"", "invented", "\" ", 0), ("width: ", "number", ";", 0), ("size = ", "number", "\n", 0), ("timeout=", "number", "\n", 0),
    ("max_tokens = ", "number", ",", 0), ("token_count: ", "number", "\n", 0), ("password = ", "ref", "\n", 0), ("api_key: \"", "ref", "\"", 0),
    ("token=", "null", "\n", 0), ("secret: ", "null", "\n", 0), ("password_file: ", "path", "\n", 0), ("private_key_path = \"", "path", "\"", 0),
    ("bearer of ", "invented", " news", 0), ("credentials ", "invented", " were", 0), ("signing ", "invented", " it", 0), ("x = ", "short", "\n", 0),
    ("user: ", "short", "\n", 0), ("filename = \"", "words", "\"", 0), ("url: https://", "url", "\n", 0), ("class=\"", "words", "\"", 0),
    ("secret santa was ", "invented", ".", 0), ("a passphrase ", "invented", " is", 0), ("label: ", "phrase", "\n", 0), ("id: ", "hex32", "\n", 0),
)

FEATURES = (
    "length", "digit_share", "upper_share", "lower_share", "sign_share", "hex_only", "digits_only", "transitions",
    "distinct_share", "longest_letters", "covered", "slashes", "dots", "dashes", "extension", "assigned", "quoted", "for_word",
    "against_word", "after_url", "followed_by_at", "key_assigned", "prefixed", "reference", "blanks",
)


def labelled_findings(spark: SparkSession) -> DataFrame:
    """before, value, after, label: each template with `VARIANTS` values that follow from a hash of its place."""
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(LABELLED)], "i int, before string, kind string, after string, label int")
    rows = rows.withColumn("v", F.explode(F.sequence(F.lit(1), F.lit(VARIANTS))))
    rows = rows.withColumn("h", F.sha2(F.concat_ws("-", "i", "v"), 256)).withColumn("b", F.base64(F.unhex("h")))
    digits = "translate(h, 'abcdef', '483920')"
    letters = "translate(h, '0123456789', 'ghirmnopus')"
    word = f"element_at(array({', '.join(repr(w) for w in DICTIONARY)}), 1 + cast(pmod(xxhash64(h, {{}}), {len(DICTIONARY)}) as int))"
    w = [word.format(i) for i in range(4)]
    kinds = {
        "hex40": "left(h, 40)", "HEX40": "upper(left(h, 40))", "hex32": "left(h, 32)", "hex64": "h",
        "base64": "left(b, 20 + 4 * cast(pmod(v, 6) as int))", "KEY20": "concat('AK', upper(left(translate(b, '+/=', 'XYZ'), 18)))",
        "mixed": "concat(left(translate(b, '+/=', '_-x'), 12), right(h, 6))",
        "uuid": "concat_ws('-', left(h, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12))",
        "digits": f"left({digits}, 16 + cast(pmod(v, 4) as int))",
        "phone": f"concat_ws('-', '0049', left({digits}, 4), substr({digits}, 5, 4), substr({digits}, 9, 4))",
        "date": "concat('2021-03-', 10 + pmod(v, 18), '-', 1000 + v, '-', 2000 + v)",
        "path": f"concat_ws('/', {w[0]}, {w[1]}, concat({w[2]}, v), concat({w[3]}, '.py'))",
        "url": f"concat('www.', {w[0]}, '.example.org/', {w[1]}, '/', {w[2]}, '-', v)",
        "email": f"concat({w[0]}, '.', {w[1]}, '.', {w[2]}, 1000 + v)",
        "words": f"concat_ws('-', {w[0]}, {w[1]}, {w[2]}, {w[3]}, v)",
        "stars": "concat('your', '-key-goes-here-', v)", "isbn": f"concat('978-3-16-', left({digits}, 6), '-', pmod(v, 10))",
        "short": f"concat({w[0]}, cast(1900 + pmod(v * 37, 150) as int))",
        "signs": f"concat({w[0]}, '!', left({digits}, 2), element_at(array('#', '$', '%', '^', '*'), 1 + pmod(v, 5)), {w[1]}, substr({digits}, 3, 2))",
        "phrase": f"concat({w[0]}, {w[1]}, {w[2]}, if(pmod(v, 2) = 0, {w[3]}, ''))",
        "letters": f"left({letters}, 20 + cast(pmod(v, 5) as int) * 4)",
        "prefixed": f"concat(element_at(array('ghp_', 'glpat-', 'sk_live_', 'npm_', 'xoxb-', 'hf_'), 1 + pmod(v, 6)), initcap(left({letters}, 24)))",
        "word": w[0], "invented": f"left({letters}, 3 + cast(pmod(v, 8) as int))", 
        "number": "concat(pmod(v * 97, 5000), element_at(array('', 'px', 'ms', 'kB', '%'), 1 + pmod(v, 5)))",
        "spaced": f"concat_ws(' ', left({letters}, 4), {w[0]}, concat(left({digits}, 2), '!', left(b, 3)), right({letters}, 2 + cast(pmod(v, 5) as int)))",
        "sentence": f"concat_ws(' ', {w[0]}, left({letters}, 5), {w[1]}, {w[2]}, right({letters}, 7))",
        "ref": f"element_at(array(concat('$', '{{', upper({w[0]}), '}}'), concat('os.environ.', {w[0]}), concat('$', upper({w[1]})), concat('get_', {w[2]}, '()')), 1 + pmod(v, 4))",
        "null": "element_at(array('null', 'None', 'true', 'undefined', '********', '...'), 1 + pmod(v, 6))",
        "build": f"concat('2.', pmod(v, 9), '.', v, '-build.', left({digits}, 8))",
    }
    value = "case kind " + " ".join(f"when '{k}' then {e}" for k, e in kinds.items()) + " end"
    return rows.select("before", F.expr(value).alias("value"), "after", "label")


def featured(rows: DataFrame) -> DataFrame:
    """Adds the features to rows with before, value and after."""
    share = "length(regexp_replace(value, '[^{}]', '')) / length(value)"
    classes = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(value, '[^A-Za-z0-9]', '.'), '[0-9]', '9'), '[a-z]', 'a'), '[A-Z]', 'A')"
    parts = "regexp_extract_all(lower(value), '[a-z]+', 0)"
    known = "array('" + "', '".join(DICTIONARY) + "')"
    length = "aggregate({}, 0, (n, x) -> n + length(x))"
    near = f"lower(right(before, {NEAR}))"
    yes = "cast({} as double)"
    exprs = {
        "length": "cast(length(value) as double)",
        "digit_share": share.format("0-9"), "upper_share": share.format("A-Z"), "lower_share": share.format("a-z"),
        "sign_share": share.format("+/_=.-"),
        "hex_only": yes.format("value rlike '^([0-9a-f]+|[0-9A-F]+)$'"), "digits_only": yes.format("value rlike '^[0-9.-]+$'"),
        "transitions": f"(length(regexp_replace({classes}, '(.)\\\\1+', '$1')) - 1) / length(value)",
        "distinct_share": "size(array_distinct(split(value, ''))) / least(length(value), 36)",
        "longest_letters": f"cast(array_max(transform(concat({parts}, array('')), x -> length(x))) as double)",
        "covered": length.format(f"filter({parts}, x -> array_contains({known}, x))") + " / length(value)",
        "slashes": "cast(length(regexp_replace(value, '[^/]', '')) as double)", "dots": "cast(length(regexp_replace(value, '[^.]', '')) as double)",
        "dashes": "cast(length(regexp_replace(value, '[^-]', '')) as double)",
        "extension": yes.format("value rlike '[.][a-z]{1,4}$'"),
        "assigned": yes.format("value rlike '^[^=]*=[^=]' or before rlike '[=:]>?\\\\s*[\"\\']?$'"),
        "quoted": yes.format("before rlike '[\"\\'`]$'"),
        "for_word": yes.format(f"{near} rlike '({FOR_WORDS})[^\\\\n]{{0,20}}$' or lower(value) rlike '({FOR_WORDS})[a-z_]*='"),
        "against_word": yes.format(f"{near} rlike '({AGAINST_WORDS})[^\\\\n]{{0,20}}$'"),
        "after_url": yes.format("before rlike '(://|www[.]|[/@])$'"),
        "followed_by_at": yes.format("after rlike '^@[a-z0-9]'"),
        "key_assigned": yes.format(
            f"{near} rlike '({FOR_WORDS})[a-z0-9_-]*[\"\\'`]?\\\\s*(:=|=>|[:=])\\\\s*[\"\\'`]?$' or lower(value) rlike '^[a-z_]*({FOR_WORDS})[a-z_]*='"
        ),
        "prefixed": yes.format(f"value rlike '^({PREFIXES})'"),
        "reference": yes.format("value rlike '^[$][({A-Za-z]|[(][)]$|^[*.]+$|environ|^(null|none|true|false|undefined|nil)$|^None$'"),
        "blanks": "cast(length(regexp_replace(value, '[^ ]', '')) as double)",
    }
    return rows.withColumns({n: F.expr(e) for n, e in exprs.items()})


def fit(findings: DataFrame) -> PipelineModel:
    """The forest from labelled findings (before, value, after, label)."""
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(featured(findings))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, place, start, value, before, after: every candidate of every whole text, places in code points."""
    found = docs.select("doc_id", "text").filter(F.col("text").rlike(CANDIDATE))
    found = found.select(
        "doc_id", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(1)).alias("pre"), F.split("text", CANDIDATE, -1).alias("gaps"),
    )
    starts = """aggregate(arrays_zip(gaps, found), named_struct('at', 0L, 'all', cast(array() as array<bigint>)),
        (s, x) -> named_struct('at', s.at + length(x.gaps) + coalesce(length(x.found), 0),
                               'all', concat(s.all, array(s.at + length(x.gaps)))), s -> s.all)"""
    earlier = f"if(i = 0, '', concat(right(gaps[i - 1], {NEAR}), right(found[i - 1], {NEAR})))"
    each = f"""transform(found, (x, i) -> named_struct('place', i, 'value', substr(x, 1 + length(pre[i])),
        'before', right(concat({earlier}, right(gaps[i], {NEAR}), right(pre[i], {NEAR})), {NEAR}),
        'after', left(gaps[i + 1], {NEAR}), 'start', starts[i] + length(pre[i])))"""
    found = found.withColumn("starts", F.expr(starts)).select("doc_id", F.explode(F.expr(each)).alias("x"))
    return found.select("doc_id", F.col("x.place").cast("long").alias("place"), "x.start", "x.value", "x.before", "x.after")


def scan(docs: DataFrame, findings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, place, start, end, value_sha256, score, secret: one row for every candidate.

    `place` counts the candidates of a text from 0; `secret` is true where the forest's score reaches the
    threshold. Null and empty texts have no candidates; equal rows give equal rows; other columns are not read.
    """
    scored = fit(stored(findings)).transform(featured(candidates(docs)))
    score = vector_to_array("probability")[1]
    return scored.select(
        "doc_id", "place", "start", (F.col("start") + F.length("value")).alias("end"), F.sha2("value", 256).alias("value_sha256"),
        score.alias("score"), (score >= threshold).alias("secret"),
    )
