"""Texts written chunk by chunk: the same ids and bytes as piece by piece, with each repeated chunk done once."""

from itertools import chain

import public_tokenizers
import regex
from riskloom.llm import bpe
from riskloom.llm.queries import BPE_FILE

PATH, PATTERN = public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "one, two. (three) four's don't I'll 's 't x's.", "été, naïve; ÀÉ! straße? ǆ Ɂ", "×÷ a×b ª º µ",
    "a.\nB c\td e  f", "x\x1cy \x1d", "42, 4a2 ٣٤ a1. ’s ‘a’ 中文, emoji 👍🏽.", "!?! a!?!b !a", "é, é. ́ ͅa",
]


def plain(tool, text):
    ids = list(chain.from_iterable(tool.piece(x.encode()) for x in regex.findall(PATTERN, text)))
    return ",".join(map(str, ids)), b"".join(tool.bytes_of[i] for i in ids)


def test_written_texts_equal_plain_pieces():
    tool = bpe.Coder(bpe.read_ranks(PATH), PATTERN, 5)  # forgets all the time
    for text in [*ODD, " ".join(ODD), "\n".join(ODD), *ODD]:
        names, data = tool.write(text)
        assert (names, data) == plain(tool, text) and data == text.encode()
        assert tool.named(tool.encode(text)) == names


def test_letters_and_marks_are_a_piece_each():
    for code in range(0x300):
        word, marks = f"a{chr(code)}", f"a{chr(code)}."
        if bpe._WORD.fullmatch(word):
            assert regex.findall(PATTERN, f" {word}") in ([f" {word}"], [" a", chr(code)]), code
        if bpe._WORD.fullmatch(marks):
            assert regex.findall(PATTERN, f" {marks}") in ([f" {word}", "."], [" a", f"{chr(code)}."]), code


def test_a_repeated_chunk_is_named_and_decoded_once(monkeypatch):
    tool = bpe.Coder(bpe.read_ranks(PATH), PATTERN)
    done = []
    monkeypatch.setattr(tool, "decode", lambda ids, decode=tool.decode: done.append(ids) or decode(ids))
    names, data = tool.write("so" + " again again." * 100)
    assert data == b"so" + b" again again." * 100 and len(done) == 3
    assert names.count(",") + 1 == len(tool.encode("so" + " again again." * 100))
