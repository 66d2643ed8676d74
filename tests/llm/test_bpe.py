import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quakespark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, text):
    want = library.encode(text, add_special_tokens=False).ids
    mine = bpe.load(PATH)
    assert mine.encode(text) == want
    assert mine.decode(want) == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t, text)


test_any_text.t = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("text", [
    "", " ", "  \n\t x", "it's we'll I'M", "don't  stop   ", "a<|endoftext|>b <|endoftext|>", "<|endoftext|>" * 3, "<|endoftext|", "é漢字🙂‍🔥   \x1c\x85x",
    "a" * 5000, "ab" * 400 + " " + "xyz" * 300, "\n" * 700 + "x", "1234567890" * 60, "ß" * 129, "the " * 3000,
])
def test_texts(library, text):
    same(library, text)


def test_every_character_falls_into_the_same_class(library):
    points = [c for c in [*range(0x20000), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}" for c in points[at : at + 4000])
        assert bpe.load(PATH).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_bytes_that_are_no_text(library):
    ids = list(range(0, 50257, 7))
    assert bpe.load(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_rows(docs, library):
    rows = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (None, "x" * 100_000)]
    columns = "doc_id bigint, text string, lang string, source string, n_tokens string, ids string"
    out = sorted(bpe.digests(docs(rows, columns), PATH).collect(), key=str)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(",".join(map(str, ids))), digest(text or "")))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    encoded = bpe.encode(docs(rows, columns), PATH)
    back = bpe.decode(encoded, PATH).collect()
    assert sorted(str((r.doc_id, r.text)) for r in back) == sorted(str((i, t or "")) for i, t in rows)
    assert bpe.digests(docs([]), PATH).collect() == []
