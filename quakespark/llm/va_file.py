"""Exact top-k by inner product with a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.llm import vectors
from quakespark.session import checkpointed

K = 10
#: Factor between a component and its integer.
SCALE = 1024
#: Cells of each dimension; a cell number is one byte.
CELLS = 256
#: Queries bounded at once.
_TOGETHER = 256
_MOST = 2.0**53


def quantise(v: np.ndarray) -> np.ndarray:
    """floor(1024 x) of every component. Raises where a component has no exact integer."""
    out = np.floor(SCALE * v)
    if out.size and np.abs(out).max() >= _MOST:
        raise ValueError("a component is too large for exact integer scores")
    return out.astype(np.int64)


class Grid:
    """Per dimension the range of the data, cut into cells; what a cell holds lies within its ``low`` and ``high``."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.first, self.width = low, high - low + 1
        step = np.arange(CELLS + 1)[:, None]
        # Python integers: a wide range times the number of cells may pass 64 bits
        edge = -((-step.astype(object) * self.width.astype(object)) // CELLS) if len(low) else np.zeros((CELLS + 1, 0))
        edge = (edge + low.astype(object)).astype(np.float64) if len(low) else edge
        self.low, self.high = edge[:-1], edge[1:] - 1

    def cells(self, x: np.ndarray) -> np.ndarray:
        wide = self.width.max(initial=0) >= 2**54
        at = (x - self.first).astype(object) * CELLS // self.width.astype(object) if wide else (x - self.first) * CELLS // self.width
        return at.astype(np.uint8)

    def bounds(self, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of each score; queries by rows."""
        at = np.arange(cells.shape[1])
        low, high = self.low[cells, at], self.high[cells, at]
        middle, half = queries @ (low + high).T / 2, np.abs(queries) @ (high - low).T / 2
        # sums below 2**53 are exact, the slack covers larger ones
        size = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T
        slack = np.where(size < _MOST / 4, 0.0, size * 1e-12)
        return middle - half - slack, middle + half + slack


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; raises where one does not fit 64 bits."""
    if rows.size and float(np.abs(rows).max()) * float(np.abs(query).max()) * rows.shape[1] >= 2.0**62:
        wide = [sum(int(a) * int(b) for a, b in zip(r, query, strict=True)) for r in rows]
        if any(abs(x) >= 2**63 for x in wide):
            raise ValueError("a score does not fit 64 bits")
        return np.array(wide, np.int64)
    return (rows * query).sum(1, dtype=np.int64)


def _grids(table: DataFrame) -> dict[int, Grid]:
    """Range of every dimension over all rows, for each vector length."""

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, ids, data in zip(batch["dim"], batch["ids"], batch["data"], strict=True):
                x = quantise(vectors.unpack(dim, ids, data)[1])
                yield pd.DataFrame({"dim": dim, "at": np.arange(dim), "low": x.min(0), "high": x.max(0)})

    found = table.mapInPandas(ranges, "dim int, at int, low bigint, high bigint")
    rows = found.groupBy("dim", "at").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    grids = {dim: g.sort_values("at") for dim, g in rows.groupby("dim")}
    out = {int(d): Grid(g["low"].to_numpy(np.int64), g["high"].to_numpy(np.int64)) for d, g in grids.items()}
    return out | {0: Grid(np.zeros(0, np.int64), np.zeros(0, np.int64))}


def approximate(table: DataFrame) -> tuple[DataFrame, dict[int, Grid]]:
    """The blocks with one more column, the cells: one byte per component. A scan for bounds reads ids and cells only."""
    grids = _grids(table)

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, ids, data in zip(batch["dim"], batch["ids"], batch["data"], strict=True):
                x = quantise(vectors.unpack(dim, ids, data)[1])
                yield pd.DataFrame({"dim": [dim], "ids": [ids], "cells": [grids[dim].cells(x).tobytes()], "data": [x.astype("<i8").tobytes()]})

    return checkpointed(table.mapInPandas(cells, "dim int, ids binary, cells binary, data binary")), grids


def _tiles(batch: pd.DataFrame, grids: dict[int, Grid]):
    """For each block and slice of its queries: ids, bounds by query, and where each query's own row is."""
    for row in batch.itertuples(index=False):
        ids = np.frombuffer(row.ids, "<i8")
        cells = np.frombuffer(row.cells, np.uint8).reshape(len(ids), row.dim)
        q_ids, q = vectors.unpack(row.dim, row.q_ids, row.q_data)
        q = quantise(q)
        for at in range(0, len(q_ids), _TOGETHER):
            part = slice(at, at + _TOGETHER)
            low, high = grids[row.dim].bounds(cells, q[part].astype(np.float64))
            yield row, ids, q_ids[part], q[part], low, high, q_ids[part][:, None] == ids[None, :]


def _floors(joined: DataFrame, grids: dict[int, Grid], k: int) -> DataFrame:
    """(query_id, floor): the kth highest lower bound over all rows, for queries with k candidates."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, _, q_ids, _, low, _, own in _tiles(batch, grids):
                low = np.where(own, -np.inf, low)
                if low.shape[1] > k:
                    low = np.partition(low, low.shape[1] - k, axis=1)[:, -k:]
                for i, values in zip(q_ids.tolist(), low, strict=True):
                    values = np.concatenate([held[i], values]) if i in held else values
                    held[i] = np.sort(values)[-k:]
        for i, values in held.items():
            yield pd.DataFrame({"query_id": i, "low": values[values > -np.inf]})

    lows = joined.select("dim", "ids", "cells", "q_ids", "q_data").mapInPandas(run, "query_id bigint, low double")
    order = W.partitionBy("query_id").orderBy(F.desc("low"))
    ranked = lows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.filter(F.col("rank") == k).select("query_id", F.col("low").alias("floor"))


def _read(joined: DataFrame, grids: dict[int, Grid], k: int) -> DataFrame:
    """(query_id, vec_id, score): the best ``k`` of each task, exact vectors read in the order of their bounds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        none = np.zeros(0, np.int64)
        for batch in batches:
            floors = {}
            for row, ids, q_ids, q, _, high, own in _tiles(batch, grids):
                if not floors:  # the same for every row
                    floors = dict(zip(row.floor_ids.tolist(), row.floor_values.tolist(), strict=True))
                data = np.frombuffer(row.data, "<i8").reshape(len(ids), row.dim)
                for i, query, bound, mine in zip(q_ids.tolist(), q, high, own, strict=True):
                    best_ids, best = held.get(i, (none, none))
                    least = max(floors.get(i, -np.inf), best[-1] if len(best) == k else -np.inf)
                    open_ = np.nonzero((bound >= least) & ~mine)[0]
                    open_ = open_[np.argsort(-bound[open_], kind="stable")]
                    for at in range(0, len(open_), 4 * k):
                        part = open_[at : at + 4 * k]
                        if len(best) == k and bound[part[0]] < best[-1]:
                            break  # no row left can enter, nor tie
                        best_ids = np.concatenate([best_ids, ids[part]])
                        best = np.concatenate([best, exact(data[part], query)])
                        keep = vectors.top(best_ids, best, k)
                        best_ids, best = best_ids[keep], best[keep]
                    held[i] = best_ids, best
        for i, (best_ids, best) in held.items():
            yield pd.DataFrame({"query_id": i, "vec_id": best_ids, "score": best})

    return joined.mapInPandas(run, "query_id bigint, vec_id bigint, score bigint")


def search(rows: DataFrame, column: str, every: int, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products over all other rows.

    Queries are the rows whose vec_id is divisible by ``every``. Components are floor(1024 x). Ties go to the smaller
    vec_id; a query with fewer candidates gets them all. Vectors are compared with vectors of their own length; what
    takes no part is said in ``vectors.valid``. Extra columns are ignored, no vectors give no rows.

    Each query block (of bounded size, broadcast) meets the file twice: the cells give the kth lower bound, then rows
    whose upper bound reaches it are read exactly, best bound first, until no bound reaches the kth score found.
    """
    spark = rows.sparkSession
    usable = checkpointed(vectors.valid(rows, column, keep_zero=True))
    table, grids = approximate(vectors.blocks(usable))
    found = None
    for block in vectors.query_blocks(usable.filter(F.col("vec_id") % every == 0)):
        met = table.join(F.broadcast(block), "dim")
        floors = _floors(met, grids, k)
        listed = floors.agg(F.collect_list(F.struct("query_id", "floor")).alias("f"))  # an entry for each query of the block
        listed = checkpointed(listed.select(F.col("f.query_id").alias("floor_ids"), F.col("f.floor").alias("floor_values")))
        part = checkpointed(_read(met.crossJoin(F.broadcast(listed)), grids, k))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")
    return vectors.best(found, k)
