"""MinHash near-dedup by SetSketch registers: banded, estimated jointly by likelihood, verified on full sets.

A register holds the smallest of a set's exponential variates, truncated to a power of ``BASE``: floor(1 - log_b h),
cut to 16 bits. The union of two sets has the larger register of both, and as ``BASE`` is near 1 two sets agree in a
register with a chance of about their similarity. Documents that agree in all registers of a band share a bucket.

A bucket is first reduced by leaders: each member is verified against one of them, what is linked is one component.
What is then still apart within a bucket is compared register by register, tile by tile. Members with a partner that the
likelihood does not exclude meet again in tiles with their full sets, where all such pairs are verified, each in the
first band it shares, until what is linked in the tiles is one component. No pair of a bucket is left out, and no pair
is a row of its own.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakespark.llm.common import from_text, may_match
from quakespark.operators.cluster import connected_components
from quakespark.session import checkpointed

#: Words of a shingle, and the similarity from which documents are linked, as a fraction.
SHINGLE, AT_LEAST = 5, (80, 100)
#: Registers of a band, and the chance that a pair just similar enough shares no bucket.
ROWS, MISS = 6, 1e-6
#: Fixed values of the sketch: base, largest register, rate of the exponential variates.
BASE, LARGEST, RATE = 1.001, (1 << 16) - 1, 20.0
#: A pair is left unverified if its registers are e to this power less likely at the asked similarity than at the best one.
DOUBT = 14.0
#: Rounds of leaders; they only save comparisons, and each costs a pass over the buckets and components anew.
ROUNDS = 1
#: Members of a tile that holds registers, and shingles of one that holds sets, on average.
TILE, TILE_SHINGLES = 512, 1 << 17

_SEED = 42
_HELD = 1 << 20
_CELLS = 1 << 21


def bands(at_least: tuple[int, int] = AT_LEAST) -> int:
    """Bands by which two sets of that similarity miss each other with a chance of ``MISS``."""
    agree = (at_least[0] / at_least[1]) ** ROWS
    return 1 if agree >= 1 else math.ceil(math.log(MISS) / math.log1p(-agree))


@functools.cache
def _numbers(n: int, seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed) for i in range(n)), np.uint64, n)


class _Words(dict):
    """64-bit hashes of words, those of a task's frequent ones at hand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _HELD:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, _SEED)
        return found


def shingle_set(text: str | None, shingle: int, hashes: dict[bytes, int]) -> np.ndarray:
    """The distinct shingles of a whole text as sorted 64-bit hashes.

    A-Z are lower-cased, words are the runs without ASCII white space. Fewer words than a shingle are one shingle; a
    null text or one without words has none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    size = min(shingle, len(words))
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    factors = _numbers(size, size) | np.uint64(1)
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for i, factor in enumerate(factors):
        h += ids[i : i + n] * factor
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)  # an odd factor and two shifts spread the bits
    h ^= h >> np.uint64(33)
    return np.unique(h)


def registers(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` registers of a set that is not empty; the registers of a union are the larger ones of its parts."""
    factor, shift = _numbers(n, 1) | np.uint64(1), _numbers(n, 2)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    rows = max(1, _CELLS // 32 // n)
    for at in range(0, len(shingles), rows):
        part = shingles[at : at + rows, None] * factor
        part += shift
        np.minimum(least, part.min(0), out=least)
    with np.errstate(divide="ignore"):
        variate = -np.log1p(-(least.astype(np.float64) / 2.0**64)) / RATE
        return np.clip(np.floor(1 - np.log(variate) / math.log(BASE)), 0, LARGEST).astype("<u2")


def _chance(x: np.ndarray) -> np.ndarray:
    """Chance that a register of one set is the larger, ``x`` being the share of the union only this set has."""
    return np.maximum(-np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE), 1e-300)


def _peak(more: np.ndarray, less: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray, asked: float) -> np.ndarray:
    """Whether the likeliest similarity reaches ``asked``, or is no more than e^``DOUBT`` times likelier."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    top = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)

    def score(j: np.ndarray) -> np.ndarray:
        larger, smaller = _chance(np.maximum(u - v * j, 0)), _chance(np.maximum(v - u * j, 0))
        return more * np.log(larger) + less * np.log(smaller) + (m - more - less) * np.log(np.maximum(1 - larger - smaller, 1e-300))

    a, b = np.zeros_like(top), top.copy()  # the likelihood has one peak
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        up = score(c) < score(d)
        a, b = np.where(up, c, a), np.where(up, b, d)
    best = (a + b) / 2
    least = np.minimum(asked, top)
    return (best >= least) | (score(best) - score(least) <= DOUBT)


@functools.cache
def _too_few(m: int, asked: float) -> int:
    """Equal registers that are far too few at similarity ``asked``: e^-(3 ``DOUBT``) by the binomial bound."""
    k = np.arange(1, math.ceil(m * asked))
    share = k / m
    gap = m * (share * np.log(share / asked) + (1 - share) * np.log((1 - share) / (1 - asked))) if asked < 1 else np.full(len(k), np.inf)
    return int(k[gap > 3 * DOUBT].max(initial=-1))


def possible(more: np.ndarray, less: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray, at_least: tuple[int, int]) -> np.ndarray:
    """Whether sets of ``n_a`` and ``n_b`` members may be as similar as ``at_least``, judged by all their registers.

    Of ``m`` registers of the first ``more`` are larger and ``less`` smaller than the second's. The similarity that
    makes these counts likeliest is found; a pair is out if the sizes forbid, or if that similarity is too small and
    ``at_least`` is e^-``DOUBT`` times less likely. Pairs with next to no equal registers are out without the search.
    """
    asked = at_least[0] / at_least[1]
    found = np.minimum(n_a, n_b) * at_least[1] >= np.maximum(n_a, n_b) * at_least[0]
    found &= m - more - less > _too_few(m, asked)
    at = np.flatnonzero(found)
    found[at] = _peak(more[at], less[at], m, n_a[at], n_b[at], asked)
    return found


def alike(a: np.ndarray, b: np.ndarray, at_least: tuple[int, int]) -> bool:
    """Whether two sorted sets are as similar as ``at_least``, exactly."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or len(a) * at_least[1] < len(b) * at_least[0]:
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both * at_least[1] >= (len(a) + len(b) - both) * at_least[0]


def _keys(*columns: str) -> list[Column]:
    """128 bits for a row of whole columns."""
    return [F.xxhash64(F.lit(seed), *(F.col(c).isNull() for c in columns), *columns).alias(f"key{seed}") for seed in (1, 2)]


def sketches(docs: DataFrame, shingle: int, n: int) -> DataFrame:
    """(doc_id, key1, key2, n_shingles, digest, registers): ``digest`` stands for the set; both are empty for an empty set."""

    def start() -> Callable[[list], list[tuple]]:
        hashes = _Words()

        def row(text: str | None) -> tuple:
            found = shingle_set(text, shingle, hashes)
            if not len(found):
                return 0, b"", b""
            return len(found), xxhash.xxh128_digest(found.tobytes()), registers(found, n).tobytes()

        return lambda texts: [row(t) for t in texts]

    keyed = docs.select("doc_id", *_keys("doc_id", "text"), "text")
    return from_text(keyed, "n_shingles bigint, digest binary, registers binary", start)


def _buckets(classes: DataFrame, n_bands: int) -> DataFrame:
    """(key, band, node, n): the classes by the registers of each band, where two of them agree in a band."""
    width = 2 * ROWS
    keys = F.array(*(F.xxhash64(F.lit(i), F.substring("registers", width * i + 1, width)) for i in range(n_bands)))
    keyed = classes.select(F.posexplode(keys).alias("band", "key"), "node", "n")
    shared = checkpointed(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"))
    return checkpointed(may_match(keyed, shared, ["key"]).join(shared, "key", "left_semi"))


def _placed(buckets: DataFrame, component: DataFrame | None) -> DataFrame:
    """``buckets`` with the component of each node so far, and only those that hold more than one."""
    if component is None:
        return buckets.withColumn("comp", F.col("node"))
    placed = checkpointed(
        buckets.join(component.select(F.col("id").alias("node"), F.col("component").alias("comp")), "node", "left")
        .withColumn("comp", F.coalesce("comp", "node"))
    )
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
    return placed.join(mixed, "key", "left_semi")


def _led(placed: DataFrame, salt: int, at_least: tuple[int, int]) -> DataFrame:
    """(a, b): each node of a bucket with the bucket's leader, where their components differ and their sizes allow a link."""
    leader = placed.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node", "n", "comp")).alias("lead"))
    sizes = F.least("n", "lead.n") * at_least[1] >= F.greatest("n", "lead.n") * at_least[0]
    found = placed.join(leader, "key").filter((F.col("comp") != F.col("lead.comp")) & sizes)
    return found.select(F.col("node").alias("a"), F.col("lead.node").alias("b")).distinct()


def _estimated(pairs: DataFrame, classes: DataFrame, at_least: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (a, b) that their registers do not exclude."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (np.frombuffer(b"".join(batch[c]), "<u2").reshape(len(batch), -1) for c in ("r_a", "r_b"))
                more, less = (a > b).sum(1), (a < b).sum(1)
                yes = possible(more, less, a.shape[1], batch["n_a"].to_numpy(), batch["n_b"].to_numpy(), at_least)
                yield batch.loc[yes, ["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a bigint, b bigint")


def _tiles(placed: DataFrame, weight: Column, most: int) -> DataFrame:
    """``placed`` with its tile of a weight of ``most``: large components of a bucket have tiles of their own (``only``)."""
    sizes = placed.groupBy("key", "comp").agg(F.sum(weight).alias("c")).withColumn("large", F.col("c") >= most)
    pool = sizes.filter(~F.col("large")).groupBy("key").agg(F.sum("c").alias("pool"))
    share = lambda what, c: F.pmod(F.xxhash64(what), F.ceil(F.col(c) / most))
    return (
        placed.join(sizes, ["key", "comp"]).join(pool, "key", "left")
        .withColumn("only", F.when(F.col("large"), F.col("comp")))
        .withColumn("tile", F.when(F.col("large"), F.xxhash64("comp", share("node", "c"))).otherwise(share("comp", "pool")))
        .drop("c", "large", "pool")
    )


def _met(members: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs of tiles of a bucket that hold different components, with arrays of ``columns`` for each side."""
    tiles = checkpointed(members.groupBy("key", "band", "tile", "only").agg(F.collect_list(F.struct(*columns)).alias("m")))
    side = lambda x: tiles.select(
        "key", "band", *(F.col(c).alias(f"{c}_{x}") for c in ("tile", "only")), *(F.col(f"m.{c}").alias(f"{c}_{x}") for c in columns))
    mixed = "tile_a < tile_b AND NOT (only_a <=> only_b AND only_a IS NOT NULL) OR tile_a = tile_b AND only_a IS NULL AND only_b IS NULL"
    return side("a").join(side("b"), ["key", "band"]).filter(mixed)


def _open_pairs(row, at_least: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs of a row of ``_met`` in different components whose registers do not exclude a link, with
    the number of equal registers; a pair counts in the first band in which it agrees."""
    a, b = (np.frombuffer(b"".join(r), "<u2").reshape(len(r), -1) for r in (row.registers_a, row.registers_b))
    low = np.minimum.outer(row.n_a, row.n_b) * at_least[1]
    met = (low >= np.maximum.outer(row.n_a, row.n_b) * at_least[0]) & (row.comp_a[:, None] != row.comp_b[None, :])
    if row.tile_a == row.tile_b:
        met &= row.node_a[:, None] < row.node_b[None, :]
    i, j = np.nonzero(met)
    m = a.shape[1]
    step = max(1, _CELLS // m)
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        equal = a[x] == b[y]
        same = equal.sum(1)
        few = same > _too_few(m, at_least[0] / at_least[1])
        x, y, equal, same = x[few], y[few], equal[few], same[few]
        here = equal.reshape(len(x), m // ROWS, ROWS).all(2).argmax(1) == row.band
        x, y, same = x[here], y[here], same[here]
        more = (a[x] > b[y]).sum(1)
        yes = possible(more, m - same - more, m, row.n_a[x], row.n_b[y], at_least)
        yield x[yes], y[yes], same[yes]


def _close(placed: DataFrame, classes: DataFrame, sets: _Sets, at_least: tuple[int, int]) -> DataFrame:
    """(a, b): verified links that connect the nodes of every bucket of ``placed`` as all pairs would, as far as they are apart."""
    known = classes.select("node", "registers")
    names = ["node", "comp", "n", "registers"]

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                found = [(row.node_a[x], row.node_b[y]) for x, y, _ in _open_pairs(row, at_least)]
                nodes = np.unique(np.concatenate([z for xy in found for z in xy])) if found else []
                if len(nodes):
                    yield pd.DataFrame({"key": row.key, "node": nodes})

    met = _met(_tiles(placed, F.lit(1), TILE).join(known, "node"), names)
    open_ = checkpointed(met.mapInPandas(mark, "key bigint, node bigint").distinct())
    full = sets.of(open_.select("node").distinct())

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                pairs = [np.concatenate(v) for v in zip(*_open_pairs(row, at_least), strict=True)]
                if not pairs or not len(pairs[0]):
                    continue
                a, b = ([np.frombuffer(v, np.uint64) for v in r] for r in (row.shingles_a, row.shingles_b))
                group = {c: c for c in {*row.comp_a.tolist(), *row.comp_b.tolist()}}

                def top(c: int, group: dict = group) -> int:
                    while group[c] != c:
                        group[c] = c = group[group[c]]
                    return c

                links = []
                for k in np.argsort(-pairs[2], kind="stable"):  # the likeliest first, so that most others are linked by then
                    x, y = pairs[0][k], pairs[1][k]
                    left, right = top(int(row.comp_a[x])), top(int(row.comp_b[y]))
                    if left != right and alike(a[x], b[y], at_least):
                        group[left] = right
                        links.append((row.node_a[x], row.node_b[y]))
                if links:
                    yield pd.DataFrame(links, columns=["a", "b"])

    again = placed.join(open_, ["key", "node"], "left_semi")
    members = _tiles(again, F.col("n"), TILE_SHINGLES).join(known, "node").join(full, "node")
    return checkpointed(_met(members, [*names, "shingles"]).mapInPandas(verify, "a bigint, b bigint"))


class _Sets:
    """Full shingle sets of nodes, read from the documents when first asked for."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shingle: int):
        self.docs, self.classes, self.shingle = docs, classes, shingle
        self.held: DataFrame | None = None

    def of(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of at least ``nodes`` (node)."""
        if self.held is not None:
            nodes = nodes.join(self.held, "node", "left_anti")
        wanted = checkpointed(self.classes.select("node", "key1", "key2").join(nodes, "node", "left_semi"))
        keyed = self.docs.select(*_keys("doc_id", "text"), "text")
        near = may_match(keyed, wanted, ["key1", "key2"]).join(wanted, ["key1", "key2"]).dropDuplicates(["node"])
        shingle = self.shingle

        def start() -> Callable[[list], list[tuple]]:
            hashes = _Words()
            return lambda texts: [(shingle_set(t, shingle, hashes).tobytes(),) for t in texts]

        new = checkpointed(from_text(checkpointed(near.select("node", "text")), "shingles binary", start))
        self.held = new if self.held is None else self.held.unionByName(new)
        return self.held


def _verified(pairs: DataFrame, sets: _Sets, at_least: tuple[int, int]) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are as similar as ``at_least``."""
    pairs = checkpointed(pairs)
    full = sets.of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    side = lambda x: full.select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yes = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), at_least) for x, y in zip(batch["s_a"], batch["s_b"], strict=True)]
            yield batch.loc[np.array(yes, bool), ["a", "b"]]

    return checkpointed(pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a bigint, b bigint"))


def linked(docs: DataFrame, classes: DataFrame, shingle: int, at_least: tuple[int, int]) -> DataFrame | None:
    """(id, component) of the ``classes`` (node, n, registers, key1, key2) that have a link; None if there is none."""
    buckets = _buckets(classes, bands(at_least))
    sets = _Sets(docs, classes, shingle)
    links, component = None, None
    for salt in [*range(ROUNDS), None]:
        placed = checkpointed(_placed(buckets, component))
        if placed.isEmpty():
            break
        if salt is None:
            new = _close(placed, classes, sets, at_least)
        else:
            new = _verified(_estimated(_led(placed, salt, at_least), classes, at_least), sets, at_least)
        if not new.isEmpty():
            links = new if links is None else links.unionByName(new)
            component = checkpointed(connected_components(links))
    return component


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, at_least: tuple[int, int] = AT_LEAST) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs`` (doc_id, text; other columns are ignored).

    Documents are linked if their sets of distinct word shingles have an intersection of ``at_least`` of their union;
    every link is confirmed on the full sets (64-bit hashes of shingles), and a pair of that similarity is missed with
    a chance of ``MISS``. ``component_id`` is the smallest doc_id reachable, itself included; ``kept`` says whether it
    is the row's own. Null texts and texts without words have no shingles, are linked with nothing and are kept. Rows
    that repeat a doc_id are documents of their own. Rows without doc_id are linked like others, but never give the
    name and are not kept; a component of such rows alone has a null name. No rows give no rows.
    """
    n = ROWS * bands(at_least)
    rows = checkpointed(sketches(docs, shingle, n).withColumn("rid", F.monotonically_increasing_id()))
    head = F.min(F.struct("rid", "key1", "key2", "n_shingles", "registers")).alias("head")
    classes = checkpointed(
        rows.filter("n_shingles > 0").groupBy("digest").agg(head, F.min("doc_id").alias("first_id"))
        .select("digest", "first_id", F.col("head.rid").alias("node"), "head.key1", "head.key2", F.col("head.n_shingles").alias("n"), "head.registers")
    )
    component = linked(docs, classes, shingle, at_least)
    named = classes.select("digest", "first_id", "node")
    if component is None:
        names = named.select("digest", F.col("first_id").alias("component_id"))
    else:
        placed = checkpointed(
            named.join(component.select(F.col("id").alias("node"), "component"), "node", "left")
            .select("digest", "first_id", F.coalesce("component", "node").alias("component"))
        )
        first = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
        names = placed.join(first, "component").select("digest", "component_id")
    some = rows.filter("n_shingles > 0").select("doc_id", "n_shingles", "digest").join(names, "digest").drop("digest")
    none = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    both = some.unionByName(none)
    return both.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
