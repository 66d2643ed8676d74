"""Approximate nearest neighbours: multi-index hashing over learned binary codes, reranked by exact cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakespark.llm import vectors
from quakespark.session import checkpointed

K = 5
BITS = 128
#: Bits of a substring; each has a table of 256 buckets.
SUB = 8
#: Vectors that rotation and radius are fitted on, in expectation; the index holds every vector.
SAMPLE = 4096
#: Share of the sample's true neighbours that the radius holds.
HOLDS = 0.98
ROUNDS, SEED = 25, 11

_SUBS = BITS // SUB
_BY_WEIGHT = [np.array([x for x in range(1 << SUB) if x.bit_count() <= t], np.uint8) for t in range(SUB + 1)]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish; cosines stay the same."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@dataclass
class Codes:
    """Centre and projections of the codes of one vector length, and the radius that is searched."""

    centre: np.ndarray
    projection: np.ndarray
    radius: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes of vectors by rows, as bytes; a byte is a substring."""
        unit = _unit(x)
        return np.packbits((unit - self.centre) @ self.projection > 0, axis=1)


def fit(sample: np.ndarray, k: int = K) -> Codes:
    """Rotations learned so that signs lose little, and the radius that holds the neighbours within the sample."""
    rng = np.random.default_rng(SEED)
    x = _unit(sample)
    centre = x.mean(0)
    z, dim = x - centre, x.shape[1]
    # principal directions first, the strongest only where there are more than bits
    _, _, axes = np.linalg.svd(z.T @ z)
    parts = []
    while sum(p.shape[1] for p in parts) < BITS:
        use = axes[: min(dim, BITS)].T
        flat = z @ use
        turn = np.linalg.qr(rng.normal(size=(use.shape[1],) * 2))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(flat.T @ np.where(flat @ turn > 0, 1.0, -1.0))
            turn = u @ v
        parts.append(use @ turn)
    codes = Codes(centre, np.concatenate(parts, 1)[:, :BITS], BITS)
    if len(x) > k + 1:
        asked = np.linspace(0, len(x) - 1, min(len(x), 256)).astype(int)
        near = x[asked] @ x.T
        near[np.arange(len(asked)), asked] = -np.inf
        true = np.argpartition(-near, k, axis=1)[:, :k]
        bits = codes.of(x)
        apart = np.bitwise_count(bits[asked][:, None, :] ^ bits[true]).sum(2, dtype=np.int64)
        codes.radius = int(np.quantile(apart, HOLDS, method="higher"))
    return codes


def _fitted(usable: DataFrame) -> dict[int, Codes]:
    n = max(1, usable.count())
    drawn = F.pmod(F.xxhash64("vec_id", F.lit("codes")), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.filter(drawn < SAMPLE / n).toPandas().sort_values("vec_id")
    groups = sample.groupby(sample["v"].map(len)) if len(sample) else ()
    return {int(dim): fit(np.stack(g["v"])) for dim, g in groups}


def index(table: DataFrame, codes: dict[int, Codes]) -> DataFrame:
    """The blocks with codes and, for each substring, the block's rows by bucket (``order``, ``starts``)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, ids, data in zip(batch["dim"], batch["ids"], batch["data"], strict=True):
                if dim in codes:
                    bits = codes[dim].of(vectors.unpack(dim, ids, data)[1])
                    order = np.argsort(bits, axis=0, kind="stable").T.astype("<i4")
                    starts = np.stack([np.searchsorted(np.sort(b), np.arange(257)) for b in bits.T]).astype("<i4")
                else:  # a length the sample has not met: no codes, every row is a candidate
                    bits, order, starts = (np.zeros(0, np.uint8),) * 3
                yield pd.DataFrame({"dim": [dim], "ids": [ids], "data": [data], "bits": [bits.tobytes()], "order": [order.tobytes()], "starts": [starts.tobytes()]})

    schema = "dim int, ids binary, data binary, bits binary, order binary, starts binary"
    return checkpointed(table.mapInPandas(run, schema))


def probe(code: np.ndarray, radius: int, bits: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Every row whose code is within ``radius`` of ``code``.

    The radius is dealt out so that (threshold + 1) sums to radius + 1 over the substrings: a code within the radius
    is within its threshold in one substring at least. The buckets of that substring are all read.
    """
    seen = np.zeros(len(bits), bool)
    least, more = divmod(radius + 1, _SUBS)
    for s in range(_SUBS):
        t = least - 1 + (s < more)
        if t < 0:
            continue
        buckets = code[s] ^ _BY_WEIGHT[min(t, SUB)]
        first, last = starts[s, buckets], starts[s, buckets.astype(np.int64) + 1]
        size = last - first
        places = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        seen[order[s, places]] = True
    rows = np.nonzero(seen)[0]
    words = bits[rows].view(np.uint64) ^ code.view(np.uint64)
    return rows[np.bitwise_count(words).sum(1, dtype=np.int64) <= radius]


def _search(table: DataFrame, block: DataFrame, codes: dict[int, Codes], k: int, exact: bool) -> DataFrame:
    """(query_id, vec_id, score): the best ``k`` of each task among the codes retrieved, or among all rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        none = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, x = vectors.unpack(row.dim, row.ids, row.data)
                x = _scaled(x)
                norms = np.sqrt((x * x).sum(1))
                q_ids, q = vectors.unpack(row.dim, row.q_ids, row.q_data)
                q = _scaled(q)
                known = codes.get(row.dim)
                if known and not exact:
                    bits = np.frombuffer(row.bits, np.uint8).reshape(len(ids), BITS // 8)
                    order = np.frombuffer(row.order, "<i4").reshape(_SUBS, len(ids))
                    starts = np.frombuffer(row.starts, "<i4").reshape(_SUBS, 257)
                    asked = known.of(q)
                for n, (i, v) in enumerate(zip(q_ids.tolist(), q, strict=True)):
                    near = probe(asked[n], known.radius, bits, order, starts) if known and not exact else np.arange(len(ids))
                    near = near[ids[near] != i]
                    score = (x[near] * v).sum(1) / (norms[near] * np.sqrt((v * v).sum()))
                    old_ids, old = held.get(i, none)
                    all_ids, all_ = np.concatenate([old_ids, ids[near]]), np.concatenate([old, score])
                    keep = vectors.top(all_ids, all_, k)
                    held[i] = all_ids[keep], all_[keep]
        for i, (best_ids, best) in held.items():
            yield pd.DataFrame({"query_id": i, "vec_id": best_ids, "score": best})

    return table.join(F.broadcast(block), "dim").mapInPandas(run, "query_id bigint, vec_id bigint, score double")


def _all(table: DataFrame, queries: DataFrame, codes: dict[int, Codes], k: int, exact: bool) -> DataFrame:
    found = None
    for block in vectors.query_blocks(queries):
        part = checkpointed(_search(table, block, codes, k, exact))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = queries.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    return vectors.best(found, k)


def search(rows: DataFrame, column: str, every: int, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found by cosine, over all other rows.

    Queries are the rows whose vec_id is divisible by ``every``. Every row within the fitted Hamming radius is
    retrieved and scored exactly; a query with fewer than ``k`` rows there is answered again from all rows. Ties go
    to the smaller vec_id; a query with fewer candidates gets them all. Vectors are compared with vectors of their
    own length; what takes no part is said in ``vectors.valid``. Extra columns are ignored, no vectors give no rows.
    """
    usable = checkpointed(vectors.valid(rows, column, keep_zero=False))
    codes = _fitted(usable)
    table = index(vectors.blocks(usable), codes)
    queries = usable.filter(F.col("vec_id") % every == 0)
    found = checkpointed(_all(table, queries, codes, k, exact=False))
    full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    few = checkpointed(queries.join(full, "vec_id", "left_anti"))
    again = _all(table, few, codes, k, exact=True)
    return found.join(few.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
