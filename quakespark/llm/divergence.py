"""Source divergence audit: how the words of sources differ, each different chunk of the corpus tokenized once.

A chunk is what stands between white space, with A-Z lower-cased. Chunks are counted in each document and added up over
blocks of documents before anything is shuffled, so the largest share a chunk can have is a row per block. A
dictionary then holds every chunk of the corpus once, with its terms and its occurrences in each group of documents,
and gives those of a term without another look at the blocks. The documents of a term are counted where that is open: a term is in at least as many as its commonest
chunk and in at most as many as all its chunks together. For terms between, no chunk of which is common, the
documents themselves are listed and told apart.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.llm.common import may_match, portions, release_memory
from quakespark.session import checkpointed

#: Maximal runs without these are terms.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 30
TOP = 50
SCALE, PRIOR = 1_000_000_000, 5

#: (document, chunk) entries of a block at most, but for those of the last portion of texts.
_BLOCK = 3_000_000
#: Bytes of the texts that are cut into chunks together.
_PORTION = 1 << 20
_ROWS = 50_000
#: Cells of a table of terms by sources that a task holds at once; where a language has many sources a tile has as
#: many terms as sources, if the second number allows, so that it gives fewer sums than it has cells.
_CELLS, _MOST_CELLS = 1 << 16, 1 << 21

_COUNTED = "chunk string, lang string, df bigint, docs array<bigint>, sources array<string>, counts array<bigint>"


class _Block:
    """Chunk counts of some documents; numbers stand for chunks, documents and groups until the end."""

    def __init__(self, least: int):
        self.least = least
        self.chunks: list[pa.Array] = []  # those of each portion; a chunk's number is its place in all of them
        self.n_chunks = 0
        self.groups: dict[tuple[str, str], int] = defaultdict(count().__next__)
        self.rids: list[int] = []
        self.group_of: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, rid: int, text: str, group: tuple[str, str]) -> None:
        self.extend([rid], pa.array([text], pa.string()), [group])

    def extend(self, rids: list[int], texts: pa.Array, groups: list[tuple[str, str]]) -> None:
        """Add documents whose texts are cut into chunks together."""
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        doc = np.repeat(np.arange(len(self.rids), len(self.rids) + len(rids)), pc.list_value_length(cut).to_numpy())
        self.rids += rids
        self.group_of += map(self.groups.__getitem__, groups)
        words = cut.flatten().dictionary_encode()
        chunk = words.indices.to_numpy()
        if (none := pc.index(words.dictionary, "").as_py()) >= 0:  # what white space at the ends leaves
            doc, chunk = doc[chunk != none], chunk[chunk != none]
        entries, n = np.unique(doc << 32 | chunk, return_counts=True)
        self.parts.append(((entries & 0xFFFFFFFF).astype(np.int32) + self.n_chunks, (entries >> 32).astype(np.int32), n.astype(np.int32)))
        self.size += len(entries)
        self.chunks.append(words.dictionary)
        self.n_chunks += len(words.dictionary)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """A row per chunk and language; the documents are listed where there are fewer than ``least``."""
        if not self.size:
            return
        groups = sorted(self.groups)
        place = np.argsort([self.groups[g] for g in groups])  # numbers of groups in their order
        chunk, doc, n = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        self.parts = []
        names = pa.concat_arrays(self.chunks).dictionary_encode()
        self.chunks = []
        chunk = names.indices.to_numpy()[chunk]
        names = names.dictionary
        group = place.astype(np.int32)[self.group_of][doc]
        order = np.argsort(chunk.astype(np.int64) * len(groups) + group)
        chunk, group, n = chunk[order], group[order], n[order]
        rid = np.array(self.rids, np.int64)[doc[order]]
        del doc, order
        langs = sorted({lang for lang, _ in groups})
        lang = np.array([langs.index(g[0]) for g in groups], np.int32)[group]

        first_of_row = np.r_[True, (np.diff(chunk) != 0) | (np.diff(lang) != 0)]
        first_of_group = first_of_row | np.r_[True, np.diff(group) != 0]
        rows, cells = np.flatnonzero(first_of_row), np.flatnonzero(first_of_group)
        df = np.diff(np.r_[rows, len(chunk)])
        counts = np.add.reduceat(n, cells, dtype=np.int64)
        cell_borders = np.r_[np.searchsorted(cells, rows), len(cells)]
        rare = df < self.least
        listed = rid[np.repeat(rare, df)]
        doc_borders = np.r_[0, np.cumsum(np.where(rare, df, 0))]
        sources = pa.array([s for _, s in groups], pa.string())
        for a in range(0, len(rows), _ROWS):
            z = min(a + _ROWS, len(rows))
            (c0, c1), (d0, d1) = cell_borders[[a, z]], doc_borders[[a, z]]
            borders = pa.array((cell_borders[a : z + 1] - c0).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    names.take(pa.array(chunk[rows[a:z]])),
                    pa.array(langs, pa.string()).take(pa.array(lang[rows[a:z]])),
                    pa.array(df[a:z].astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array((doc_borders[a : z + 1] - d0).astype(np.int32)), pa.array(listed[d0:d1])),
                    pa.ListArray.from_arrays(borders, sources.take(pa.array(group[cells[c0:c1]]))),
                    pa.ListArray.from_arrays(borders, pa.array(counts[c0:c1])),
                ],
                [c.split()[0] for c in _COUNTED.split(", ")],
            )


def chunk_counts(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(chunk, lang, df, docs, sources, counts): chunks by block and language, for rows (rid, text, lang, source) without nulls.

    ``df`` documents of the block have the chunk; ``docs`` lists them if fewer than ``least``. ``counts`` are the
    occurrences in each of ``sources``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(least)
        for batch in batches:
            for part in portions(batch, _PORTION):
                rids, langs, sources = (part.column(c).to_pylist() for c in ("rid", "lang", "source"))
                block.extend(rids, part.column("text"), list(zip(langs, sources, strict=True)))
                if block.size >= _BLOCK:
                    yield from block.rows()
                    block = _Block(least)
        yield from block.rows()
        release_memory()

    return docs.select("rid", "text", "lang", "source").mapInArrow(run, _COUNTED)


def dictionary(counted: DataFrame) -> DataFrame:
    """(chunk, terms, langs, cells): every chunk once, its terms in order, and where it is.

    ``langs`` has the documents of each language, ``cells`` the occurrences ``n`` in each source of a language; a row
    holds as many as there are groups of documents.
    """
    rows = counted.select("chunk", "lang", "df", "sources", "counts").repartition("chunk")
    cells = rows.select("chunk", "lang", "df", "counts", F.posexplode("sources").alias("at", "source")).select(
        "chunk", "lang", "source", F.when(F.col("at") == 0, F.col("df")).otherwise(0).alias("df"), F.get("counts", "at").alias("n")
    )
    cells = cells.groupBy("chunk", "lang", "source").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    whole = cells.groupBy("chunk").agg(F.collect_list(F.struct("lang", "source", "df", "n")).alias("cells"))  # an entry per group
    terms = F.regexp_extract_all("chunk", F.lit(TERM), F.lit(0))
    df_of = lambda lang: F.aggregate("cells", F.lit(0).cast("bigint"), lambda s, c: s + F.when(c["lang"] == lang, c["df"]).otherwise(0))
    several = F.transform(F.array_distinct("cells.lang"), lambda x: F.struct(x.alias("lang"), df_of(x).alias("df")))
    one = F.array(F.struct(F.get("cells.lang", F.lit(0)).alias("lang"), F.get("cells.df", F.lit(0)).alias("df")))
    langs = F.when(F.size("cells") == 1, one).otherwise(several)
    return whole.select("chunk", terms.alias("terms"), langs.alias("langs"), "cells").filter(F.size("terms") > 0)


def _times() -> Column:
    """The different terms of a chunk, and how often it has each."""
    one = F.array(F.struct(F.get("terms", F.lit(0)).alias("term"), F.lit(1).alias("times")))
    several = F.transform(
        F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), F.size(F.filter("terms", lambda x: x == t)).alias("times"))
    )
    return F.explode(F.when(F.size("terms") == 1, one).otherwise(several))


def kept_terms(counted: DataFrame, chunks: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term) of the terms in ``least`` documents of their language."""
    held = chunks.select("chunk", F.explode("langs").alias("l"), "terms").select("l.lang", "chunk", "l.df", _times().alias("t"))
    held = held.select("lang", "chunk", "df", "t.term")
    bounds = held.groupBy("lang", "term").agg(F.max("df").alias("low"), F.sum("df").alias("high"))
    bounds = checkpointed(bounds.filter(F.col("high") >= least).select("lang", "term", (F.col("low") >= least).alias("sure")))

    wanted = bounds.filter(~F.col("sure")).select("lang", "term")
    open_ = checkpointed(may_match(held.drop("df"), wanted, ["lang", "term"]).join(wanted, ["lang", "term"]))
    listed = may_match(counted.select("lang", "chunk", "docs").filter(F.size("docs") > 0), open_, ["lang", "chunk"])
    found = listed.join(open_, ["lang", "chunk"]).select("lang", "term", F.explode("docs").alias("rid")).distinct()
    more = found.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return checkpointed(bounds.filter("sure").select("lang", "term").unionByName(more.select("lang", "term")))


def term_counts(chunks: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, n): occurrences of the ``kept`` terms, from the dictionary."""
    cells = chunks.select(F.explode("cells").alias("c"), "terms").select("c.lang", "c.source", "c.n", _times().alias("t"))
    cells = may_match(cells.select("lang", "source", "t.term", (F.col("n") * F.col("t.times")).alias("n")), kept, ["lang", "term"])
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(kept, ["lang", "term"], "left_semi")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), exact also where a product passes 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = (wide(n) + PRIOR) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, wide(total) + wide(terms) * F.lit(PRIOR).cast("decimal(2,0)")) + 1


def _differences(key: tuple, cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums of absolute differences of shares over the terms of a tile, for every pair of its sources."""
    sources = pd.Index(sorted(groups["source"]))
    rest = groups.set_index("source")["rest"].reindex(sources).to_numpy()
    lines, terms = pd.factorize(cells["term"])
    table = np.tile(rest, (len(terms), 1)).astype(np.int64)
    table[lines, sources.get_indexer(cells["source"])] = cells["p"].to_numpy()
    table = np.ascontiguousarray(table.T)
    out = [np.abs(table[a + 1 :] - table[a]).sum(1) for a in range(len(sources))]
    a, b = np.triu_indices(len(sources), 1)
    return pd.DataFrame({"lang": key[0], "a": sources[a], "b": sources[b], "value": np.concatenate([*out, np.array([], np.int64)])})


def _pairs(shares: DataFrame, groups: DataFrame, cells: int) -> DataFrame:
    """(lang, source, item, value) for all pairs of a language's sources; a tile holds some terms and all sources."""
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"), F.max("n_terms").alias("n_terms"))
    held = F.greatest(F.lit(cells), F.least(F.col("n_sources") * F.col("n_sources"), F.lit(_MOST_CELLS)))
    langs = langs.select("lang", F.greatest(F.lit(1), F.ceil(F.col("n_terms") * F.col("n_sources") / held)).cast("int").alias("n_tiles"))
    left = shares.join(langs, "lang").select("lang", F.pmod(F.xxhash64("term"), "n_tiles").cast("int").alias("tile"), "source", "term", "p")
    zero = F.lit(0)
    rest = F.coalesce(F.when(F.col("n_terms") > 0, _share(zero, F.col("total"), F.col("n_terms"))), zero.cast("bigint"))
    right = groups.join(langs, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)).alias("tile"), "source", rest.alias("rest"))
    sums = left.groupBy("lang", "tile").cogroup(right.groupBy("lang", "tile")).applyInPandas(
        _differences, "lang string, a string, b string, value bigint"
    )
    total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return total.select("lang", F.explode(ways).alias("w"), "value").select("lang", "w.*", "value")


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, cells: int = _CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs from the others and from the language.

    ``docs`` (text, lang, source; other columns are ignored; nulls are read as empty strings) counts by rows, repeated
    ones too. Of a language's terms those in ``least`` of its documents are kept. A term's share in a group of
    documents is floor(10^9 * (n + 5) / (total + 5 * kept terms)) + 1. Part ``pair``: the sum of the absolute
    differences of all shares to every other source of the language (0 if no term is kept), all ranks; as many rows as
    there are pairs of sources. Part ``term``: the terms whose share is above the language's, with the difference, to
    rank ``top``; ties by the item's bytes. A source without terms has its pairs and no terms; no documents, no rows.
    """
    empty = F.lit("")
    read = docs.select(F.monotonically_increasing_id().alias("rid"), *(F.coalesce(c, empty).alias(c) for c in ("text", "lang", "source")))
    counted = checkpointed(chunk_counts(read, least))
    chunks = checkpointed(dictionary(counted))
    kept = kept_terms(counted, chunks, least)
    counts = checkpointed(term_counts(chunks, kept))

    zero = F.lit(0).cast("bigint")
    n_terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = checkpointed(
        read.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(n_terms, "lang", "left")
        .select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("n_terms", zero).alias("n_terms"))
    )
    shares = counts.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("n_terms")))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("n_terms").alias("n_terms"))
    of_lang = (
        counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(whole, "lang")
        .select("lang", "term", _share(F.col("n"), F.col("total"), F.col("n_terms")).alias("q"))
    )
    by_value = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (
        shares.select("lang", "source", "term", "p").join(of_lang, ["lang", "term"]).filter(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    )
    pairs = _pairs(shares.select("lang", "source", "term", "p"), groups, cells).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank")
    )
    return pairs.unionByName(terms)
