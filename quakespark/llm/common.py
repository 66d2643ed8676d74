"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """64 bits for a row; rows that repeat every one of ``columns`` share it. Nulls count as a value."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return F.xxhash64(F.lit(len(columns)), *parts)


def tasks(spark: SparkSession) -> int:
    """Partitions for work that costs much per byte, which size-based coalescing would put into few tasks."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def fold(column: str, parts: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; null ids count as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of the texts that a task turns into Python strings together.
PORTION = 1 << 22


def portions(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have about ``size`` bytes together; a longer text alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(), dtype=np.int64)
    a = 0
    while a < len(ends):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield batch.slice(a, z - a)
        a = z


def release_memory() -> None:
    """Give back what Arrow holds of batches that are gone; a Python worker waits for its next task with it otherwise."""
    pa.default_memory_pool().release_unused()


def from_text(docs: DataFrame, columns: str, compute: Callable[[], Callable[[list], list[tuple]]]) -> DataFrame:
    """``docs`` with ``columns`` (a DDL list), computed from whole texts, in place of ``text``; the others pass unchanged.

    ``compute()`` is called once for a task and gives the function from some texts to a tuple for each.
    """
    new = StructType.fromDDL(columns)
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = compute()
        for batch in batches:
            rows = [r for part in portions(batch, PORTION) for r in function(part.column("text").to_pylist())]
            made = [pa.array([r[i] for r in rows]) for i in range(len(new))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *made], [f.name for f in (*rest, *new)])
            del batch, rows, made
            release_memory()

    return docs.mapInArrow(run, StructType([*rest, *new]))


#: Bits of a filter that keeps most rows without a partner out of a join's shuffle; its size does not grow with the input.
_FILTER_BITS = 1 << 26


def may_match(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose ``keys`` may occur in ``wanted``, for an exact join behind it.

    What is broadcast is a field of ``_FILTER_BITS`` bits, whatever the input: no row that has a partner is lost, a full
    field only lets more of the others through.
    """
    at = F.xxhash64(*keys).bitwiseAND(F.lit(_FILTER_BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    word, bits = unused(df, "_word"), unused(df, "_bits")
    field = wanted.select(F.shiftright(at, 6).alias(word), bit.alias(bits)).groupBy(word).agg(F.bit_or(bits).alias(bits))
    near = df.withColumn(word, F.shiftright(at, 6)).join(F.broadcast(field), word)
    return near.filter(F.col(bits).bitwiseAND(bit) != 0).drop(word, bits)
