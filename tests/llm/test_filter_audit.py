import itertools
import re

import pytest
from pyspark.sql import functions as F

from quakespark.llm import filter_audit

LONG = " ".join(f"word{i}" for i in range(120))
TWICE = " ".join(f"word{i % 60}" for i in range(120))
LOUD = " ".join(f"WORD{i}" for i in range(120))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (4, TWICE, "en"), (5, TWICE + " #", "en"), (6, LOUD, "de"), (7, None, None),
    (8, "", ""), (9, "short & sweet", "en"), (9, "short & sweet", "en"), (None, LONG, "en"), (None, None, None), (10, LOUD, "en"),
    (11, "É" * 9 + "A", "fr"), (12, "É" * 8 + "AA", "fr"), (13, "a|b\x0b\x1c c " * 40000, "fr"), (0, "tie", "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, None, 1), (5, 1, None), (9, 1, 1), (None, 1, 1), (99, 1, 1), (10, 1, 0)]


def brute(docs, labels, letters="ABCDE"):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    failing = []
    for i, text, _ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        same = [j for j, u, _ in docs if (u or "") == t and j is not None]
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and min(same) < i,
        }
        failing.append({x for x in letters if fails[x]})
    rows, removed_by = {}, {}
    parts = {lang or "" for _, _, lang in docs}
    for part, order in itertools.product(parts, itertools.permutations(letters)):
        here = [k for k, d in enumerate(docs) if (d[2] or "") == part]
        left = set(here)
        for step, f in enumerate(order, 1):
            out = {k for k in left if f in failing[k]}
            again = {k for k in here if f in failing[k]} - out
            left -= out
            alone = sum(failing[k] == {f} for k in here)
            lost = [sum(docs[k][0] in s for k in out) for s in (good, bad)]
            rows[part, "".join(order), step] = [len(left), len(out), len(again), alone, *lost]
            removed_by[part, f] = removed_by.get((part, f), 0) + len(out)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def found(df):
    assert df.columns[:3] == ["part", "filter_order", "step"]
    rows = df.collect()
    assert len({r[:3] for r in rows}) == len(rows)
    return {tuple(r[:3]): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}


@pytest.fixture
def tables(spark):
    def make(docs, labels):
        clash = "doc_id bigint, text string, lang string, part string, rid int, filter string, prefix int, good int, fails string"
        return (
            spark.createDataFrame([(*d, "x", 1, "y", 2, 3, "z") for d in docs], clash).repartition(3),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("t")),
        )

    return make


def test_against_brute_force(tables):
    got = found(filter_audit.audit(*tables(DOCS, LABELS)))
    assert got == brute(DOCS, LABELS)
    assert len(got) == 4 * 120 * 5


def test_no_labels(tables):
    few = DOCS[:6]
    assert found(filter_audit.audit(*tables(few, []))) == brute(few, [])


def test_no_documents(tables):
    assert filter_audit.audit(*tables([], LABELS)).collect() == []


def test_filters_of_ones_own(tables):
    docs, labels = tables(DOCS, LABELS)
    own = lambda t: "".join(x for x in filter_audit.failures(t) if x in "AD")
    assert found(filter_audit.audit(docs, labels, own, "AD")) == brute(DOCS, LABELS, "ADE")
    with pytest.raises(ValueError, match="repeated"):
        filter_audit.audit(docs, labels, own, "AE")


def test_a_table_for_each_filter(tables):
    members, failing = filter_audit.failing_ids(*tables(DOCS, LABELS))
    assert members.count() == len(DOCS) == members.select("rid").distinct().count()
    assert {r["filter"] for r in failing.collect()} == set("ABCDE")
    assert failing.distinct().count() == failing.count()
