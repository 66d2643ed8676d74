"""Language ID by unigram piece probabilities, summed over all segmentations of a word."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakespark.llm.common import fold, release_memory

#: Documents of each language that the probabilities are learned from, in expectation.
TRAIN_DOCS = 300
#: Rounds of expectation and maximisation.
ROUNDS = 4
#: Characters of the longest piece of the vocabulary, the start mark included; longer ones would be left out.
LONGEST = 16
#: Count given to every piece of the vocabulary before it is seen.
PRIOR = 0.02
#: Words whose scores a task remembers, and words scored together.
REMEMBERED, TOGETHER = 1 << 19, 1 << 14
#: Characters of the texts whose words are looked up together.
PORTION = 1 << 20
#: Characters up to which a word's probability needs no scale.
SHORT = 24
UNDETERMINED = "und"

_START = "▁"
_LETTERS = regex.compile(r"\p{L}+")


@lru_cache(maxsize=4)
def _pieces(path: str) -> dict[str, int]:
    """The pieces of a SentencePiece vocabulary that can occur in a lower-cased word; 0 is any other character."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = sorted(
        p for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        and len(p := model.id_to_piece(i)) <= LONGEST and p == p.lower() and _LETTERS.fullmatch(p.removeprefix(_START) or "a")
    )
    return {p: i + 1 for i, p in enumerate(found)}


def words_of(text: str | None) -> list[str]:
    """The runs of letters of a text, lower-cased."""
    return _LETTERS.findall((text or "").lower())


class _Lattice:
    """Words of one length with the piece on every arc; ``score`` and ``expect`` run over all words at once.

    Arcs without a piece point behind the vocabulary, to a row of zeros.
    """

    def __init__(self, words: list[str], pieces: dict[str, int]):
        self.n, self.length = len(words), len(words[0]) + 1
        texts = [_START + w for w in words]
        none, find = len(pieces) + 1, pieces.get
        self.arcs: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(self.length + 1)]  # by end
        for end in range(1, self.length + 1):
            for start in range(max(0, end - LONGEST), end):
                # one character always makes an arc, as piece 0 at least
                missing = 0 if end - start == 1 else none
                arc = np.array([find(t[start:end], missing) for t in texts], np.int32)
                if not missing or (arc != none).any():
                    self.arcs[end].append((start, arc))

    def forward(self, p: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Sums up to each position, and the logarithm of their scale; words by languages. ``p`` ends with zeros."""
        shape = (self.n, p.shape[1])
        sums = [np.ones(shape)] + [np.zeros(shape) for _ in range(self.length)]
        scale = np.zeros((self.length + 1, self.n))
        scaled = self.length > SHORT
        for at in range(1, self.length + 1):
            # earlier sums are brought to the scale of the one before, at most LONGEST steps away
            scale[at] = scale[at - 1]
            for start, arc in self.arcs[at]:
                step = sums[start] * p[arc]
                sums[at] += step * np.exp(scale[start] - scale[at])[:, None] if scaled else step
            if scaled:
                top = sums[at].max(1)
                sums[at] /= top[:, None]
                scale[at] += np.log(top)
        return sums, scale

    def score(self, p: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        sums, scale = self.forward(p)
        return np.log(np.maximum(sums[-1], 1e-300)) + scale[-1][:, None]

    def expect(self, p: np.ndarray, counts: np.ndarray, out: np.ndarray) -> None:
        """Add the expected uses of each piece, words counted ``counts`` times in each language."""
        sums, scale = self.forward(p)
        back = [np.zeros_like(sums[0]) for _ in range(self.length)] + [np.ones_like(sums[0])]
        lift = np.zeros_like(scale)
        total = np.maximum(sums[-1], 1e-300)
        for end in range(self.length, 0, -1):
            # all arcs from here on are in: bring the sum to scale, then pass it to the starts of the arcs that end here
            top = back[end].max(1)
            back[end] /= top[:, None]
            lift[end] += np.log(top)
            for start, arc in self.arcs[end]:
                inside = np.exp(scale[start] + lift[end] - scale[-1])[:, None]
                used = sums[start] * p[arc] * back[end] * inside / total * counts
                for k in range(p.shape[1]):
                    out[:, k] += np.bincount(arc, used[:, k], len(out) + 1)[:-1]
            # sums not yet complete keep the scale of the position after them
            for start in range(max(0, end - LONGEST), end):
                back[start] *= np.exp(lift[start] - lift[end])[:, None]
                lift[start] = lift[end]
            for start, arc in self.arcs[end]:
                back[start] += back[end] * p[arc]


def _padded(p: np.ndarray) -> np.ndarray:
    return np.concatenate([p, np.zeros((1, p.shape[1]))])


def _by_length(words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for group in groups.values():
        for at in range(0, len(group), TOGETHER):
            part = group[at : at + TOGETHER]
            yield part, [words[i] for i in part]


class Model:
    """Languages and their piece probabilities."""

    def __init__(self, path: str, languages: list[str], p: np.ndarray):
        self.path, self.languages, self.p = path, languages, p

    def words(self, words: list[str]) -> np.ndarray:
        out, p = np.zeros((len(words), len(self.languages))), _padded(self.p)
        for index, part in _by_length(words):
            out[index] = _Lattice(part, _pieces(self.path)).score(p)
        return out


def fit(counts: pd.DataFrame, path: str, rounds: int = ROUNDS) -> Model:
    """Piece probabilities from (lang, word, n) by expectation and maximisation over all segmentations."""
    languages = sorted(counts["lang"].unique())
    pieces = _pieces(path)
    if not languages:
        return Model(path, [], np.zeros((len(pieces) + 1, 0)))
    words = sorted(counts["word"].unique())
    place = {w: i for i, w in enumerate(words)}
    table = np.zeros((len(words), len(languages)))
    np.add.at(table, (counts["word"].map(place).to_numpy(), counts["lang"].map(languages.index).to_numpy()), counts["n"].to_numpy(float))
    size = len(pieces) + 1
    p = np.full((size, len(languages)), 1.0 / size)
    lattices = [(index, _Lattice(part, pieces)) for index, part in _by_length(words)]
    for _ in range(rounds):
        used = np.full((size, len(languages)), PRIOR)
        for index, lattice in lattices:
            lattice.expect(_padded(p), table[index], used)
        p = used / used.sum(0)
    return Model(path, languages, p)


def train(docs: DataFrame, path: str, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from a sample of ``docs`` (doc_id, text, lang) with text and language, ``train_docs`` of each language.

    The sample is drawn by a hash of the id at a rate of ``train_docs`` over the documents of the language. Only the
    counts of its words reach the driver.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each column of the model
    if not sizes:
        return fit(pd.DataFrame({"lang": [], "word": [], "n": []}), path)
    rate = F.create_map(*(F.lit(x) for row in sizes for x in (row["lang"], train_docs / row["n"])))[F.col("lang")]
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(drawn < rate).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                found.update((lang, w) for w in words_of(text))
            yield pd.DataFrame([(a, b, n) for (a, b), n in found.items()], columns=["lang", "word", "n"])

    words = sample.mapInPandas(count, "lang string, word string, n bigint")
    counts = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).toPandas()
    return fit(counts, path)


class _Scorer:
    """Scores texts with a model; remembers words."""

    def __init__(self, model: Model):
        self.model = model
        self.place: dict[str, int] = {}
        self.rows = np.zeros((REMEMBERED, len(model.languages)))

    def total(self, words: list[str]) -> np.ndarray:
        """Sum of the words' log probabilities."""
        out = np.zeros(len(self.model.languages))
        for at in range(0, len(words), REMEMBERED // 4):
            part = words[at : at + REMEMBERED // 4]
            new = [w for w in set(part) if w not in self.place]
            if len(self.place) + len(new) > REMEMBERED:
                self.place.clear()
                new = list(set(part))
            if new:
                first = len(self.place)
                self.rows[first : first + len(new)] = self.model.words(new)
                self.place.update(zip(new, range(first, first + len(new)), strict=True))
            index = np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))
            out += self.rows[index].sum(0)
        return out

    def predict(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        total = self.total(words)
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def _portions(texts: pd.Series) -> Iterator[list]:
    """Texts of about ``PORTION`` characters together; a longer one alone."""
    part, size = [], 0
    for text in texts:
        length = len(text or "")
        if part and size + length > PORTION:
            yield part
            part, size = [], 0
        part.append(text)
        size += length
    if part:
        yield part


def prediction(spark: SparkSession, model: Model, text: str | Column) -> Column:
    """Struct (lang_pred, score) of each whole text: the likeliest language and its posterior at even odds.

    Null texts and texts without a letter are ``und`` with score 0; ties go to the first language by name.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(shared.value)
        for texts in batches:
            found = []
            for part in _portions(texts):
                # words new to the task are scored many at a time
                lists = [words_of(t) for t in part]
                fresh = set().union(*lists) - scorer.place.keys()
                if len(lists) > 1 and len(fresh) <= REMEMBERED // 4:
                    scorer.total(list(fresh))
                found += [scorer.predict(words) for words in lists]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])
            del texts, found
            release_memory()

    return predict(text)


def identify(docs: DataFrame, path: str, parts: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), a row for each row of ``docs`` (doc_id, text, lang).

    Learns from the folds of crc32(doc_id) mod ``parts`` other than ``held_out``. Without labelled rows all is ``und``.
    """
    out = fold("doc_id", parts) == held_out
    model = train(docs.filter(~out), path)
    found = docs.select("doc_id", out.alias("held_out"), prediction(docs.sparkSession, model, "text").alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
