"""Vectors packed into blocks of bounded size, for searches of a query set against all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.llm.common import tasks
from quakespark.session import checkpointed

#: Rows and bytes of a block at most (a single vector may be longer).
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20

PACKED = "dim int, ids binary, data binary"


def valid(vectors: DataFrame, column: str, keep_zero: bool) -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles.

    Null ids, null vectors and vectors that hold a null or non-finite component are left out, zero vectors too unless
    ``keep_zero``. Rows that share an id count once, with the smallest of their vectors.
    """
    v = F.col(column).cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    if not keep_zero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def pack(rows: DataFrame, parts: int) -> DataFrame:
    """Blocks (dim, ids, data) of (vec_id, v), each of vectors of one length: int64 ids and float64 rows as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def block(dim: int) -> pd.DataFrame:
            ids, data = zip(*held.pop(dim), strict=True)
            packed = np.concatenate(data).astype("<f8") if dim else np.zeros(0)
            return pd.DataFrame({"dim": [dim], "ids": [np.array(ids, "<i8").tobytes()], "data": [packed.tobytes()]})

        for batch in batches:
            for i, v in zip(batch["vec_id"], batch["v"], strict=True):
                mine = held.setdefault(len(v), [])
                mine.append((i, v))
                if len(mine) >= BLOCK_ROWS or len(mine) * len(v) * 8 >= BLOCK_BYTES:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)

    return rows.repartition(parts).mapInPandas(run, PACKED)


def unpack(dim: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, "<i8")
    return keys, np.frombuffer(data, "<f8").reshape(len(keys), dim)


def blocks(rows: DataFrame) -> DataFrame:
    """All of (vec_id, v) as a written table of blocks, dealt evenly over the tasks."""
    n = rows.count()
    return checkpointed(pack(rows, max(tasks(rows.sparkSession), -(-n // BLOCK_ROWS))))


def query_blocks(rows: DataFrame) -> list[DataFrame]:
    """The query set as single-row frames (dim, q_ids, q_data), each of a block's size at most.

    The driver learns the blocks' names only.
    """
    n = rows.count()
    if not n:
        return []
    table = checkpointed(pack(rows, -(-n // BLOCK_ROWS)).withColumn("name", F.expr("uuid()")))
    names = [r["name"] for r in table.select("name").collect()]
    return [table.filter(F.col("name") == name).select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data")) for name in sorted(names)]


def best(found: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` highest scores of (query_id, vec_id, score), ties to the smaller vec_id, with their rank."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.nonzero(scores >= least)[0]
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]
