"""Toxicity: a convolutional text classifier over hashed word embeddings, trained on every labelled document.

A word's embedding is the sum of two hashed rows, one for the word and one for its first letters. Filters of several
widths slide over the words, each keeps its maximum over the whole text, and a linear layer makes the logit. A score
is the logit moved by a threshold for the text's language, so that one cut serves all languages; the language is
guessed from the words by a table learned beside the filters, never read from a column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakespark.llm.common import fold, may_match
from quakespark.session import checkpointed

#: Labelled documents in a file of the training table, whose files are learned from side by side, and the most files; beyond, they grow.
PART_DOCS, MOST_PARTS = 4096, 256
BUCKETS = 1 << 18
DIMENSIONS, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PREFIX = 4
PASSES, BATCH, RATE, SEED = 6, 16, 0.05, 7
#: Score at which a document is called toxic.
CUT = 0.7
#: Labelled documents of each class that a language needs for a threshold of its own.
LEAST = 15
#: Words held at once.
_SLICE = 1 << 16
REMEMBERED = 1 << 18
_OUTPUTS, _TAPS = len(WIDTHS) * FILTERS, sum(WIDTHS) * FILTERS
#: Bins for a unit of the logit, and the largest logit told apart.
_BINS, _FAR = 4096, 60
#: Fixed point of the averaged weights.
_POINT = float(1 << 26)
_VALUES = [f"v{i}" for i in range(DIMENSIONS + 1)]

_WORD = re.compile(r"\w+")


class _Buckets(dict):
    """The two buckets of a word; starts anew when full."""

    def __missing__(self, word: str) -> tuple[int, int]:
        pair = crc32(word.encode()) % BUCKETS, crc32(word[:PREFIX].encode(), 1) % BUCKETS
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = pair
        return pair


def buckets_of(text: str | None, memory: _Buckets) -> np.ndarray:
    """Two bucket numbers for each word of a whole text."""
    pairs = list(map(memory.__getitem__, _WORD.findall((text or "").lower())))
    return np.array(pairs, np.int32).reshape(-1, 2)


@dataclass
class Model:
    """``row``: the embedding that a bucket uses, 0 (all zero) for buckets of no weight."""

    row: np.ndarray
    embedding: np.ndarray
    filters: np.ndarray  # dimensions x all taps
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    languages: np.ndarray  # log share of a bucket in each language
    thresholds: np.ndarray  # by language
    taps: np.ndarray = field(init=False)

    def __post_init__(self):
        self.taps = (self.embedding @ self.filters).astype(np.float32)

    def logit(self, pairs: np.ndarray) -> float:
        best = np.zeros(len(self.bias))
        last = max(WIDTHS) - 1
        for at in range(0, len(pairs), _SLICE):
            part = pairs[at : at + _SLICE + last]  # overlaps the next by what the widest filter needs
            rows = self.taps[self.row[part[:, 0]]] + self.taps[self.row[part[:, 1]]]
            if at + _SLICE + last >= len(pairs):
                rows = np.concatenate([rows, np.zeros((last, rows.shape[1]), rows.dtype)])
                best = np.maximum(best, _pooled(rows) + self.bias)
                break
            best = np.maximum(best, _pooled(rows) + self.bias)
        return float(best @ self.weights + self.offset)

    def language(self, pairs: np.ndarray) -> int:
        total = np.zeros(self.languages.shape[1])
        for at in range(0, len(pairs), _SLICE):
            total += self.languages[pairs[at : at + _SLICE, 0]].sum(0)
        return int(total.argmax())

    def score(self, pairs: np.ndarray) -> float:
        x = self.logit(pairs) - self.thresholds[self.language(pairs)] + np.log(CUT / (1 - CUT))
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def _spans() -> Iterator[tuple[int, slice, list[slice]]]:
    """Width, place among the outputs, and the places of its taps."""
    at = 0
    for k, width in enumerate(WIDTHS):
        yield width, slice(k * FILTERS, (k + 1) * FILTERS), [slice(at + i * FILTERS, at + (i + 1) * FILTERS) for i in range(width)]
        at += width * FILTERS


def _pooled(rows: np.ndarray) -> np.ndarray:
    """Largest response of each filter; the last ``max(WIDTHS) - 1`` rows only follow, a text ends with zeros there."""
    out = np.empty(len(WIDTHS) * FILTERS)
    n = len(rows) - max(WIDTHS) + 1
    for _, place, taps in _spans():
        out[place] = sum(rows[i : i + n, tap] for i, tap in enumerate(taps)).max(0)
    return out


@dataclass
class Weights:
    """What learning moves, and the sums of squared gradients that set its steps. The last embedding row stays zero."""

    embedding: np.ndarray
    embedding_sums: np.ndarray  # by row
    dense: np.ndarray  # filters, bias, weights and offset
    dense_sums: np.ndarray

    @classmethod
    def start(cls) -> Weights:
        rng = np.random.default_rng(SEED)
        e = rng.normal(0, 0.05, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
        e[BUCKETS] = 0
        dense = np.concatenate([rng.normal(0, 0.3, DIMENSIONS * _TAPS), np.zeros(_OUTPUTS), rng.normal(0, 0.3, _OUTPUTS), [0.0]])
        return cls(e, np.full(BUCKETS + 1, 1e-8), dense, np.full(len(dense), 1e-8))

    def copy(self) -> Weights:
        return Weights(self.embedding.copy(), self.embedding_sums.copy(), self.dense.copy(), self.dense_sums.copy())


def _split(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Views of filters, bias, weights and offset."""
    w, b, v, c = np.split(dense, np.cumsum([DIMENSIONS * _TAPS, _OUTPUTS, _OUTPUTS]))
    return w.reshape(DIMENSIONS, _TAPS), b, v, c


def _peaks(embedding: np.ndarray, filters: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter over a whole text, and the word where it begins; the text ends with zero rows."""
    last = max(WIDTHS) - 1
    high, where = np.full(_OUTPUTS, -np.inf), np.zeros(_OUTPUTS, np.int64)
    for at in range(0, len(pairs) - last, _SLICE):
        part = pairs[at : at + _SLICE + last]
        y = filters.T @ (embedding[part[:, 0]] + embedding[part[:, 1]]).T
        n = len(part) - last
        response = np.concatenate([sum(y[tap, i : i + n] for i, tap in enumerate(taps)) for _, _, taps in _spans()])
        spot = response.argmax(1)
        found = response[np.arange(_OUTPUTS), spot]
        better = found > high
        high[better], where[better] = found[better], spot[better] + at
    return high, where


def _learn(to: Weights, rows: list[tuple[np.ndarray, int, float]], updates: np.ndarray) -> None:
    """One step on a batch of (bucket pairs, toxic, weight); ``updates`` counts the steps of each embedding row."""
    size = len(rows)
    rows = [r for r in rows if len(r[0])]
    if not rows:
        return
    w, b, v, c = _split(to.dense)
    end = np.full((max(WIDTHS) - 1, 2), BUCKETS, np.int32)
    texts = [np.concatenate([pairs, end]) for pairs, _, _ in rows]
    narrow = w.astype(np.float32)
    peaks = [_peaks(to.embedding, narrow, t) for t in texts]
    high, where = np.array([p[0] for p in peaks]) + b, np.array([p[1] for p in peaks])
    h = np.maximum(high, 0)
    truth, weight = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    error = (1 / (1 + np.exp(-np.clip(h @ v + c[0], -50, 50))) - truth) * weight / size
    g = error[:, None] * v * (high > 0)
    gw, at, moves = np.zeros_like(w), [], []
    for _, out, taps in _spans():
        for k, tap in enumerate(taps):
            ids = np.array([t[spots] for t, spots in zip(texts, where[:, out] + k, strict=True)])
            x = to.embedding[ids[..., 0]] + to.embedding[ids[..., 1]]
            gw[:, tap] = np.einsum("bf,bfd->df", g[:, out], x)
            move = (g[:, out, None] * w[:, tap].T).reshape(-1, DIMENSIONS)
            for side in (0, 1):
                at.append(ids[..., side].ravel())
                moves.append(move)
    at, moves = np.concatenate(at), np.concatenate(moves)
    moved = (at != BUCKETS) & moves.any(1)
    at, place = np.unique(at[moved], return_inverse=True)
    ge = np.zeros((len(at), DIMENSIONS))
    np.add.at(ge, place, moves[moved])
    grad = np.concatenate([gw.ravel(), g.sum(0), error @ h, [error.sum()]])
    to.dense_sums += grad**2
    to.dense -= RATE * grad / np.sqrt(to.dense_sums)
    to.embedding_sums[at] += (ge**2).mean(1)
    to.embedding[at] -= RATE * ge / np.sqrt(to.embedding_sums[at])[:, None]
    updates[at] += 1


def _shares(seen: np.ndarray) -> np.ndarray:
    """Log shares of the buckets in each language from their counts."""
    return np.log((seen + 1.0) / (seen + 1.0).sum(0)).astype(np.float32)


def _constant(always: bool, languages: np.ndarray) -> Model:
    """Without texts of both classes every score is the same."""
    nothing, flat = np.zeros(_OUTPUTS), np.zeros(languages.shape[1])
    filters = np.zeros((DIMENSIONS, _TAPS))
    return Model(np.zeros(BUCKETS, np.int32), np.zeros((1, DIMENSIONS)), filters, nothing, nothing, 20.0 if always else -20.0, languages, flat)


def _model(learned: Weights, languages: np.ndarray) -> Model:
    """What learning left near its random start says nothing: those buckets share the zero row."""
    strong = np.linalg.norm(learned.embedding[:BUCKETS], axis=1) > 0.25
    row = np.zeros(BUCKETS, np.int32)
    row[strong] = np.arange(1, strong.sum() + 1)
    w, b, v, c = _split(learned.dense)
    embedding = np.concatenate([np.zeros((1, DIMENSIONS)), learned.embedding[:BUCKETS][strong]])
    return Model(row, embedding, w, b, v, float(c[0]), languages, np.zeros(languages.shape[1]))


def _bin(logit: float) -> int:
    return int(np.floor(np.clip(logit, -_FAR, _FAR) * _BINS))


def _threshold(counts: pd.DataFrame) -> float:
    """The cut with the best F1 among the ends of the bins of ``counts`` (bin, toxic, n); in the middle of the gap that gives it."""
    by_bin = counts.assign(hit=counts["n"] * counts["toxic"]).groupby("bin")[["n", "hit"]].sum().sort_index(ascending=False)
    bins, taken, hit = by_bin.index.to_numpy(), by_bin["n"].cumsum().to_numpy(), by_bin["hit"].cumsum().to_numpy()
    best = int((2 * hit / (taken + hit[-1])).argmax())
    return float(bins[best] + bins[best + 1] + 1) / 2 / _BINS if best + 1 < len(bins) else float(bins[best]) / _BINS


def _set_thresholds(model: Model, counts: pd.DataFrame) -> None:
    """Thresholds from ``counts`` (guess, bin, toxic, n): one for all, and one of its own for each language with enough rows."""
    model.thresholds[:] = _threshold(counts)
    for k, mine in counts.groupby("guess"):
        if all(mine["n"][mine["toxic"] == t].sum() >= LEAST for t in (0, 1)):
            model.thresholds[k] = _threshold(mine)


def _class_weights(n: dict[int, int]) -> dict[int, float]:
    """Both classes weigh the same in all."""
    return {t: 0.5 * (n[0] + n[1]) / n[t] for t in (0, 1)}


def fit(texts: list[np.ndarray], toxic: np.ndarray, langs: list[str], epochs: int = PASSES) -> Model:
    """The model of a few texts held in memory (``train`` is the same for tables); a quarter sets the thresholds."""
    names = sorted(set(langs)) or [""]
    seen = np.zeros((BUCKETS, len(names)))
    for pairs, name in zip(texts, langs, strict=True):
        np.add.at(seen[:, names.index(name)], pairs[:, 0], 1)
    if len(set(toxic.tolist())) < 2:
        return _constant(bool(len(toxic) and toxic[0]), _shares(seen))
    learn = np.random.default_rng(SEED).random(len(texts)) >= 0.25
    if len(set(toxic[learn].tolist())) < 2 or len(set(toxic[~learn].tolist())) < 2:
        learn[:] = True
    weight = _class_weights({t: int((toxic[learn] == t).sum()) for t in (0, 1)})
    rows = [(texts[i], int(toxic[i]), weight[int(toxic[i])]) for i in np.nonzero(learn)[0]]
    learned = Weights.start()
    for _ in range(epochs):
        for at in range(0, len(rows), BATCH):
            _learn(learned, rows[at : at + BATCH], np.zeros(BUCKETS + 1, np.int64))
    model = _model(learned, _shares(seen))
    held = np.arange(len(texts)) if learn.all() else np.nonzero(~learn)[0]
    counts = pd.DataFrame([(model.language(texts[i]), _bin(model.logit(texts[i])), int(toxic[i]), 1) for i in held], columns=["guess", "bin", "toxic", "n"])
    _set_thresholds(model, counts)
    return model


def _pairs_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The bucket pairs of the rows of an Arrow batch."""
    lists = batch.column("pairs")
    flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [flat[i:j].reshape(-1, 2) for i, j in zip(ends[:-1], ends[1:], strict=True)]


def _fixed(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Values times ``n`` in fixed point, so that sums do not depend on the order of their terms."""
    return np.round(np.clip(values, -1e4, 1e4) * _POINT).astype(np.int64) * n[:, None]


def _emit(learned: Weights, updates: np.ndarray, documents: int) -> pa.RecordBatch:
    """The weights of a task: a row (key, n, v0, v1, ...) for every embedding row it moved, and for pieces of the dense ones."""
    at = np.nonzero(updates)[0]
    dense = np.concatenate([learned.dense, np.sqrt(learned.dense_sums)])
    dense = np.append(dense, np.zeros(-len(dense) % (DIMENSIONS + 1))).reshape(-1, DIMENSIONS + 1)
    values = np.concatenate([np.column_stack([learned.embedding[at], np.sqrt(learned.embedding_sums[at])]), dense])
    n = np.minimum(np.append(updates[at], np.full(len(dense), documents)), 1000)
    keys = np.append(at, BUCKETS + 1 + np.arange(len(dense))).astype(np.int32)
    columns = [pa.array(keys), pa.array(n), *map(pa.array, _fixed(values, n).T)]
    return pa.RecordBatch.from_arrays(columns, ["key", "n", *_VALUES])


def _one_pass(rows: DataFrame, weight: dict[int, float], start: Weights) -> Weights:
    """Every task learns from its rows, beginning with the same weights; then the mean of what the tasks have moved."""
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, waiting = shared.value.copy(), []
        updates, documents = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for pairs, toxic in zip(_pairs_of(batch), batch.column("toxic").to_pylist(), strict=True):
                waiting.append((pairs.copy(), toxic, weight[toxic]))  # a view would hold its whole batch
                documents += 1
                if len(waiting) == BATCH:
                    _learn(mine, waiting, updates)
                    waiting = []
        if documents:
            _learn(mine, waiting, updates)
            yield _emit(mine, updates, documents)

    schema = "key int, n bigint, " + ", ".join(f"{v} bigint" for v in _VALUES)
    sums = rows.select("pairs", "toxic").mapInArrow(learn, schema).groupBy("key").agg(*[F.sum(v).alias(v) for v in ("n", *_VALUES)])
    got = sums.toArrow()  # a row for each bucket at most
    shared.destroy()
    keys, n = got["key"].to_numpy(), got["n"].to_numpy()
    values = np.column_stack([got[v].to_numpy() for v in _VALUES]) / _POINT / n[:, None]
    end, new = keys <= BUCKETS, start.copy()
    new.embedding[keys[end]] = values[end, :DIMENSIONS]
    new.embedding_sums[keys[end]] = values[end, DIMENSIONS] ** 2
    dense = values[~end][np.argsort(keys[~end])].ravel()
    size = len(start.dense)
    new.dense, new.dense_sums = dense[:size], dense[size : 2 * size] ** 2
    return new


def _language_counts(rows: DataFrame) -> np.ndarray:
    """How often a bucket (rows) is the word of a language's (columns, by name) texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, pairs in zip(batch.column("lang").to_pylist(), _pairs_of(batch), strict=True):
                np.add.at(seen.setdefault(lang, np.zeros(BUCKETS, np.int64)), pairs[:, 0], 1)
        for lang, n in seen.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "bucket", "n"])

    names = sorted(r["lang"] for r in rows.select("lang").distinct().collect()) or [""]
    got = rows.select("lang", "pairs").mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    place = {name: i for i, name in enumerate(names)}
    out = np.zeros((BUCKETS, len(names)))
    out[got["bucket"].to_numpy(), np.array([place[x] for x in got["lang"].to_pylist()], np.int64)] = got["n"].to_numpy()
    return out


def _tallies(rows: DataFrame, model: Model) -> pd.DataFrame:
    """(guess, bin, toxic, n): rows by guessed language, logit and class."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = _pairs_of(batch)
            columns = [pa.array([m.language(t) for t in texts], pa.int32()), pa.array([_bin(m.logit(t)) for t in texts], pa.int32()), batch.column("toxic")]
            yield pa.RecordBatch.from_arrays(columns, ["guess", "bin", "toxic"])

    placed = rows.select("pairs", "toxic").mapInArrow(place, "guess int, bin int, toxic int")
    return placed.groupBy("guess", "bin", "toxic").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on every row of ``docs`` (doc_id, text, lang) with a label in ``labels`` (doc_id, toxic).

    Ids that carry both labels are left out. The bucket pairs are written once, dealt to files by a hash of the id;
    tasks learn from the files side by side, and their weights are averaged after every pass. A quarter sets the thresholds. Only
    weights and counts by bucket, language and logit bin reach the driver.
    """
    given = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")
    ).filter("toxic = _most").select("doc_id", F.col("toxic").cast("int"))
    parts = min(MOST_PARTS, max(1, -(-given.count() // PART_DOCS)))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Buckets()
        for batch in batches:
            flat = [buckets_of(t, memory).ravel() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(flat, pa.list_(pa.int32()))], ["doc_id", "lang", "pairs"])

    drawn = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(4))
    # only rows that may have a label are shuffled, once, into the parts that the table keeps
    texts = may_match(docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), "text"), given, ["doc_id"])
    dealt = texts.mapInArrow(pairs, "doc_id bigint, lang string, pairs array<int>").repartition(parts, "doc_id")
    rows = (
        dealt.join(given.repartition(parts, "doc_id").hint("merge"), "doc_id").withColumn("learn", drawn > 0)
        .sortWithinPartitions(F.xxhash64("doc_id", F.lit("order")), "doc_id", F.xxhash64("pairs"))
    )
    rows = checkpointed(rows)
    sizes = {(r["toxic"], r["learn"]): r["n"] for r in rows.groupBy("toxic", "learn").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = {t: sizes.get((t, True), 0) + sizes.get((t, False), 0) for t in (0, 1)}
    languages = _shares(_language_counts(rows))
    if not n[0] or not n[1]:
        return _constant(n[1] > 0, languages)
    learn = held = rows
    if all(sizes.get((t, x), 0) for t in (0, 1) for x in (True, False)):
        learn, held = rows.filter("learn"), rows.filter("not learn")
        n = {t: sizes[t, True] for t in (0, 1)}
    learned = Weights.start()
    for _ in range(PASSES):
        learned = _one_pass(learn, _class_weights(n), learned)
    model = _model(learned, languages)
    _set_thresholds(model, _tallies(held, model))
    return model


def scores(docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each row of ``docs`` (doc_id, text, lang).

    Learns from the folds of crc32(doc_id) mod ``parts`` other than ``held_out``; scores read the text alone. Null
    and empty texts are scored as texts without words. Without labels of both classes no text is toxic, or all are.
    """
    out = fold("doc_id", parts) == held_out
    model = train(docs.filter(~out), labels.filter(~(fold("doc_id", parts) == held_out)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memory, m = _Buckets(), shared.value
        for texts in batches:
            yield pd.Series([m.score(buckets_of(t, memory)) for t in texts], dtype=float)

    found = docs.select("doc_id", out.alias("held_out"), score("text").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
