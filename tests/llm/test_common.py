import pyarrow as pa

from quakespark.llm import common


def test_texts_of_a_batch_are_read_in_portions(docs):
    rows = [(i, "x" * 3_000_000) for i in range(4)] + [(7, None), (8, "")]
    seen = common.from_text(docs(rows, "doc_id bigint, text string", 1), "n bigint, together bigint", lambda: lambda texts: [(len(t or ""), sum(len(t or "") for t in texts)) for t in texts])
    got = sorted(map(tuple, seen.collect()))
    assert [x[:2] for x in got] == [(i, len(t or "")) for i, t in rows]
    assert all(together <= common.PORTION for *_, together in got)


def test_portions():
    batch = pa.RecordBatch.from_arrays([pa.array([None, "ab", "abcdef", "", "é", "c", None])], ["text"])
    cut = lambda size: [p.column("text").to_pylist() for p in common.portions(batch, size)]
    assert cut(3) == [[None, "ab"], ["abcdef"], ["", "é", "c", None]]
    assert cut(100) == [batch.column("text").to_pylist()]
    assert sum(cut(1), []) == batch.column("text").to_pylist()
    assert list(common.portions(batch.slice(0, 0), 3)) == []


def test_memory_of_a_batch_is_given_back(monkeypatch):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    class Docs:
        schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(common.StructType, "fromDDL", classmethod(lambda _, ddl: StructType([StructField("n", LongType())])))
    calls = []
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(1))
    run = common.from_text(Docs(), "n bigint", lambda: lambda texts: [(len(t),) for t in texts])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a", "bc"])], ["doc_id", "text"])
    assert [b.column("n").to_pylist() for b in run(iter([batch, batch]))] == [[1, 2], [1, 2]]
    assert len(calls) == 2
