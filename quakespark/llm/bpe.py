"""Byte-level BPE with a contiguous rank array, and its inverse."""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakespark.llm.common import from_text

#: Fixed value: how this family of vocabularies cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes up to which a word is merged by scanning its rank array; longer ones use a queue over the same boundaries.
SHORT = 256
#: Words whose ids a task remembers.
REMEMBERED = 1 << 18

_NONE = 1 << 30


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable bytes for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary with its merges, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()

        model = spec["model"]
        self.id_of = {raw(t): i for t, i in model["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank_of = {(raw(a), raw(b)): r for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: t for t, i in self.id_of.items()} | {i: t.encode() for t, i in self.special.items()}
        self.digits_of = {i: str(i) for i in self.bytes_of}
        self._word = regex.compile(PATTERN)
        names = sorted(self.special, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._seen = _Remembered(self)

    def encode(self, text: str) -> list[int]:
        if self._cut is None or not self._cut.search(text):
            return list(chain.from_iterable(map(self._seen.__getitem__, self._word.findall(text))))
        ids: list[int] = []
        for part in self._cut.split(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                ids.extend(chain.from_iterable(map(self._seen.__getitem__, self._word.findall(part))))
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank is joined, leftmost first, until no pair has a rank."""
        bounds = self._scan(word) if len(word) <= SHORT else self._queue(word)
        return [self.id_of[word[a:b]] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _scan(self, word: bytes) -> list[int]:
        rank_of = self.rank_of
        bounds = list(range(len(word) + 1))
        ranks = [rank_of.get((word[i : i + 1], word[i + 1 : i + 2]), _NONE) for i in range(len(word) - 1)]
        while ranks and (lowest := min(ranks)) != _NONE:
            i = ranks.index(lowest)
            del bounds[i + 1], ranks[i]
            if i:
                left = word[bounds[i - 1] : bounds[i]], word[bounds[i] : bounds[i + 1]]
                ranks[i - 1] = rank_of.get(left, _NONE)
            if i < len(ranks):
                right = word[bounds[i] : bounds[i + 1]], word[bounds[i + 1] : bounds[i + 2]]
                ranks[i] = rank_of.get(right, _NONE)
        return bounds

    def _queue(self, word: bytes) -> list[int]:
        """The same boundaries in n log n; an entry counts only while its two parts still stand."""
        n = len(word)
        before, after = list(range(-1, n)), [*range(1, n + 1), n + 1]  # of each boundary, the neighbouring ones
        queue: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if 0 <= a and b < n:
                c = after[b]
                rank = self.rank_of.get((word[a:b], word[b:c]))
                if rank is not None:
                    heapq.heappush(queue, (rank, a, b, c))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = bytearray(n + 1)
        while queue:
            _, a, b, c = heapq.heappop(queue)
            if gone[a] or gone[b] or gone[c] or after[a] != b or after[b] != c:
                continue
            gone[b] = 1
            after[a], before[c] = c, a
            offer(before[a], a)
            offer(a, c)
        return [i for i in range(n + 1) if not gone[i]]


class _Remembered(dict):
    """Ids of words seen before; starts anew when full."""

    def __init__(self, bpe: Bpe):
        self._bpe = bpe

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(self._bpe.merge(raw := word.encode()))
        if len(raw) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """One vocabulary per process and file."""
    return Bpe(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, a row for each row of ``docs`` (doc_id, text); a null text has none."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([load(path).encode(t or "") for t in texts], dtype=object)

    return docs.select("doc_id", ids("text").alias("ids"))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids count as none, bytes that are not UTF-8 become U+FFFD."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([load(path).decode(() if x is None else x) for x in ids], dtype=object)

    return tokens.select("doc_id", text("ids").alias("text"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row for each row of ``docs`` (doc_id, text).

    Encodes and decodes in one pass, so ids and texts never leave the task. A null text counts as empty; repeated
    rows give repeated results; extra columns are ignored.
    """

    def start():
        bpe = load(path)

        def digest(text: str | None) -> tuple[int, str, str]:
            ids = bpe.encode(text or "")
            joined = ",".join(map(bpe.digits_of.__getitem__, ids))
            return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()

        return lambda texts: [digest(t) for t in texts]

    return from_text(docs.select("doc_id", "text"), "n_tokens bigint, ids_sha256 string, decoded_sha256 string", start)
