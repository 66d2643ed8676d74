import os

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from quakespark.llm import line_dedup, pareto_mix, queries, simhash
from quakespark.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    want = con.sql(queries.ORACLES[name])
    out = queries.QUERIES[name](spark, SF)
    assert sorted(out.columns) == sorted(want.columns)
    key = lambda row: tuple(str(round(x, 6) if isinstance(x, float) else x) for x in row)
    assert sorted(key(r) for r in out.select(*want.columns).collect()) == sorted(key(r) for r in want.fetchall())


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) <= names and set(queries.ORACLES) <= set(__spark_entry__.oracle_sql())
    assert {n.split("_")[0] for n in queries.QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    out = corpus_pipeline.run(spark, SF).collect()
    known = corpus_pipeline.known_language(spark, docs, SF)
    assert known.columns == docs.columns and known.count() == docs.count()  # every text has letters here
    lines = line_dedup.without_repeats(known)
    single = simhash.one_of_each(lines)
    assert single.columns == docs.columns
    kept = {r.doc_id: r.text for r in single.collect()}
    groups = {}
    for r in simhash.near_duplicates(lines).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert set(kept) == set(groups)
    copies = {r.doc_id: r.n_copies for r in pareto_mix.drawn(single).collect() if r.size and r.n_copies}
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == copies


def test_stages_on_odd_rows(spark, docs):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, found string, _found int, key string, size int"
    rows = [(1, "some words to read here", "en", "a", 23), (1, "some words to read here", "en", "a", 23), (2, None, None, None, None), (3, "", "en", "a", 0), (None, "mots à lire ici et là", "fr", None, 21), (5, "w " * 30_000, "en", "b", 60_000)]
    for frame in (docs(rows, columns), docs([], columns)):
        now = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF)
            assert now.columns == frame.columns
            now = spark.createDataFrame(now.collect(), now.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
        assert "ids_sha256" in last.columns
        last.collect()
