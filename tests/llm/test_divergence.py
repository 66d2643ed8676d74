import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quakespark.llm import divergence
from quakespark.llm.common import portions


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(docs, least, top=50):
    groups, terms_of, df = defaultdict(Counter), {}, Counter()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        terms = [lower(t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang, source].update(terms)
        df.update((lang, t) for t in set(terms))
    for lang in {k for k, _ in groups}:
        terms_of[lang] = {t for (x, t), n in df.items() if x == lang and n >= least}
    share = lambda c, kept: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
    rows = set()
    for (lang, source), c in groups.items():
        kept = terms_of[lang]
        p = share(c, kept)
        whole = sum((g for (x, _), g in groups.items() if x == lang), Counter())
        q = share(whole, kept)
        pair = [(-sum(abs(p[t] - share(g, kept)[t]) for t in kept), s) for (x, s), g in groups.items() if x == lang and s != source]
        term = [(q[t] - p[t], t) for t in kept if c[t] > 0 and p[t] > q[t]]
        for part, found in (("pair", sorted(pair, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(term, key=lambda x: (x[0], x[1].encode()))[:top])):
            rows |= {(lang, source, part, item, -v, rank) for rank, (v, item) in enumerate(found, 1)}
    return rows


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def some_docs(seed=1, n=90):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "the,", "THE-end", "x1y", "x", "naïve", "NAÏVE", "Straße", "é", "12", "--", "a.b.a", " z ", "ſ", "日本", "b\x1cc"]
    words += [f"rare{chr(97 + i)}{k}" for i in range(6) for k in range(30)]  # no chunk is common, the terms are
    docs = []
    for _ in range(n):
        text = "".join(words[i] + [" ", "\n", "\x0b", "\t"][rng.integers(4)] for i in rng.integers(0, len(words), rng.integers(0, 40)))
        docs.append((text, [None, "", "en", "de"][rng.integers(4)], [None, "", "s1", "s2", "é", "S"][rng.integers(6)]))
    return docs + [(None, "en", "mute"), ("", "fr", None), ("the " * 50_000, "en", "s1"), docs[0], docs[0]]


@pytest.fixture
def table(spark):
    def make(rows):
        clash = "text string, lang string, source string, rid string, chunk int, term int, doc_id int, rank int, n int"
        return spark.createDataFrame([(*r, "r", 1, 2, None, 4, 5) for r in rows], clash).repartition(3)

    return make


@pytest.mark.parametrize("least", [1, 4, 9])
def test_against_brute_force(table, least):
    docs = some_docs(least)
    assert found(divergence.audit(table(docs), least=least)) == brute(docs, least)


def test_small_blocks_and_tiles_change_nothing(table, monkeypatch):
    docs = some_docs(5)
    monkeypatch.setattr(divergence, "_BLOCK", 20)
    monkeypatch.setattr(divergence, "_MOST_CELLS", 7)
    assert found(divergence.audit(table(docs), least=4, top=3, cells=7)) == brute(docs, 4, 3)


def test_block():
    def rows(least, rows_at_once, monkeypatch):
        monkeypatch.setattr(divergence, "_ROWS", rows_at_once)
        block = divergence._Block(least)
        for rid, text, group in [(7, "b a A", ("en", "s")), (8, "", ("en", "s")), (9, "a c", ("de", "t")), (3, "a", ("en", "r"))]:
            block.add(rid, text, group)
        return [r for batch in block.rows() for r in batch.to_pylist()]

    with pytest.MonkeyPatch.context() as m:
        for at_once in (1, 2, 100):
            got = rows(2, at_once, m)
            assert sorted((r["chunk"], r["lang"], r["df"], r["docs"], r["sources"], r["counts"]) for r in got) == [
                ("a", "de", 1, [9], ["t"], [1]), ("a", "en", 2, [], ["r", "s"], [1, 2]), ("b", "en", 1, [7], ["s"], [1]), ("c", "de", 1, [9], ["t"], [1]),
            ]
    assert list(divergence._Block(2).rows()) == []


def test_every_chunk_is_in_the_dictionary_once(spark, table):
    from pyspark.sql import functions as F

    rows = [("a,b A-a b", "en", "s"), ("a,b 12", "de", "s"), ("a,b", "en", "t")]
    read = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("rid", F.monotonically_increasing_id())
    got = divergence.dictionary(divergence.chunk_counts(read, 2)).collect()
    assert sorted((r.chunk, r.terms, sorted(map(tuple, r.langs))) for r in got) == [
        ("a,b", ["a", "b"], [("de", 1), ("en", 2)]), ("a-a", ["a", "a"], [("en", 1)]), ("b", ["b"], [("en", 1)]),
    ]


def test_shares_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(9 * 10**17, 9 * 10**18, 3)], "n bigint, total bigint, terms bigint")
    got = row.select(divergence._share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first().p
    assert got == 1 + 10**9 * (9 * 10**17 + 5) // (9 * 10**18 + 15)


def test_no_rows(table):
    assert divergence.audit(table([])).collect() == []


def test_no_term_is_kept(table):
    docs = [("a b", "en", "s"), ("c", "en", "t"), (None, "en", "u")]
    assert found(divergence.audit(table(docs))) == brute(docs, 30)


def test_dictionary_knows_where_a_chunk_is(spark):
    from pyspark.sql import functions as F

    rows = [("a,b A-a", "en", "s"), ("a,b  a,b", "en", "t"), ("a,b\n", "de", "s"), ("", "fr", "s")]
    read = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("rid", F.monotonically_increasing_id())
    chunks = divergence.dictionary(divergence.chunk_counts(read, 9)).cache()
    cells = {r.chunk: sorted((c.lang, c.source, c.n) for c in r.cells) for r in chunks.collect()}
    assert cells == {"a,b": [("de", "s", 1), ("en", "s", 1), ("en", "t", 2)], "a-a": [("en", "s", 1)]}
    kept = spark.createDataFrame([("en", "a"), ("de", "b"), ("fr", "a")], "lang string, term string")
    got = sorted((r.lang, r.source, r.term, r.n) for r in divergence.term_counts(chunks, kept).collect())
    assert got == [("de", "s", "b", 1), ("en", "s", "a", 3), ("en", "t", "a", 2)]


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_portions_of_texts_change_nothing(size):
    import pyarrow as pa

    docs = [(t or "", lang or "", s or "") for t, lang, s in some_docs(3)]
    texts, langs, sources = (pa.array(x) for x in zip(*docs, strict=True))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), texts, langs, sources], ["rid", "text", "lang", "source"])
    block = divergence._Block(5)
    parts = list(portions(batch, size))
    assert sum(p.num_rows for p in parts) == len(docs) and (size > 40 or len(parts) > 60)
    for p in parts:
        rids, langs, sources = (p.column(c).to_pylist() for c in ("rid", "lang", "source"))
        block.extend(rids, p.column("text"), list(zip(langs, sources, strict=True)))
    got = {(r["chunk"], r["lang"]): r for b in block.rows() for r in b.to_pylist()}
    counts, df = Counter(), defaultdict(set)
    for rid, (text, lang, source) in enumerate(docs):
        for word in text.encode().lower().split():
            counts[word.decode(), lang, source] += 1
            df[word.decode(), lang].add(rid)
    assert got.keys() == df.keys()
    assert {k: len(v) for k, v in df.items()} == {k: r["df"] for k, r in got.items()}
    assert all(sorted(r["docs"]) == (sorted(df[k]) if len(df[k]) < 5 else []) for k, r in got.items())
    assert counts == {(*k, s): n for k, r in got.items() for s, n in zip(r["sources"], r["counts"], strict=True)}
