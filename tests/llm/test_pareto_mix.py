import hashlib
import math
import random
import re

import pytest

from quakespark.llm import pareto_mix

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(SPACE.findall(text or ""))


def plain(rows):
    """(doc_id, size, source_size, target, taken) by the contract, one source after another."""
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s))
    total = {s: sum(size(t) for _, t, x in rows if x == s) for s in sources}
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sources)}
    level, full = 0.0, None
    while full != (now := {s for s in sources if weight[s] * level > 2 * total[s]}):
        full = now
        left = sum(weight[s] for s in sources if s not in full)
        if not left:
            level = math.inf
            break
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in full)) / left
    out = []
    for s in sources:
        target = min(2.0 * total[s], weight[s] * level)
        r = target / total[s] if total[s] else 0.0
        whole, mine, upto = math.floor(r), [], 0
        for i, t, x in rows:
            if x == s:
                row = "|".join(["mix", "" if i is None else str(i), t or ""])
                u = (int(hashlib.md5(row.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                mine.append((u, i is None, i if i is not None else 0, t, i))
        for _, _, _, t, i in sorted(mine, key=lambda m: m[:3] + (m[3] or "",)):
            upto += size(t)
            extra = r > whole and upto - size(t) / 2 <= target - whole * total[s]
            out.append((i, size(t), total[s], target, int((whole + extra) * size(t))))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "b", "Z", "é", None, "z"])
        rows.append((i, " ".join(["w"] * rng.choice([1, 5, 30, rng.randrange(400)])), source))
    return rows


def mixed(docs, rows, **kw):
    columns = "doc_id bigint, text string, source string, size string, target int, taken int, key string, w double, u double"
    return pareto_mix.drawn(docs(rows, columns), **kw)


def bare(found):
    return sorted(map(str, ((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in found)))


@pytest.mark.parametrize("buckets", [1024, 3])
def test_against_one_sorted_list(docs, monkeypatch, buckets):
    monkeypatch.setattr(pareto_mix, "BUCKETS", buckets)
    rows = [*corpus(3, 400), (None, "a b\x0bc\x1cd é", "a"), (None, None, "void"), (1000, "", "void"), (1001, None, None)]
    want = plain(rows)
    found = mixed(docs, rows).collect()
    assert bare(found) == sorted(str((i, n, m, round(t, 6), k)) for i, n, m, t, k in want)
    by = {}
    for (i, n, m, t, k) in want:
        by.setdefault((m, t), []).append((k, n))
    for (_, target), docs_ in by.items():
        assert abs(sum(k for k, _ in docs_) - target) <= max(n for _, n in docs_) / 2 + 1e-6
        assert all(k <= 2 * n for k, n in docs_)


def test_reruns_and_partitions_agree(spark, docs):
    rows = corpus(5, 120)
    columns = "doc_id bigint, text string, source string"
    a = pareto_mix.drawn(docs(rows, columns, parts=1)).collect()
    b = pareto_mix.drawn(docs(rows[::-1], columns, parts=5)).collect()
    assert bare(a) == bare(b)


def test_rows_that_repeat(docs):
    rows = [(1, "a b c", "s")] * 40 + [(2, "d e f", "t")] * 3
    found = mixed(docs, rows).collect()
    assert len(found) == 43 and all(r.taken % r.size == 0 and r.taken <= 2 * r.size for r in found)
    total = sum(r.taken for r in found if r.source_size == 120)
    assert abs(total - [r.target for r in found if r.source_size == 120][0]) <= 1.5


def test_mix_copies_rows(docs):
    rows = corpus(7, 80) + [(500, None, "a"), (501, " ", "a"), (502, "x y z", "b"), (502, "x y z", "b")]
    columns = "doc_id bigint, text string, source string, _key string, _n int, n_copies int, rows int"
    table = docs(rows, columns)
    want = {}
    for r in pareto_mix.drawn(table).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + (r.n_copies if r.size else 0)
    out = pareto_mix.mix(table)
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert out.columns == table.columns and got == {i: n for i, n in want.items() if n}


def test_no_rows(docs):
    assert pareto_mix.drawn(docs([])).collect() == []
    assert pareto_mix.mix(docs([])).collect() == []
    assert [r.taken for r in pareto_mix.drawn(docs([(1, None, None, None)])).collect()] == [0]


def test_native(docs):
    plan = pareto_mix.mix(docs(corpus(1, 20), "doc_id bigint, text string, source string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_mix_keeps_rows_that_share_id_and_text(docs):
    """Rows of one id and text in two sources, and with other columns that differ, are rows of their own."""
    columns = "doc_id bigint, text string, source string, note string"
    rows = [(1, "some words here", "a", "x"), (1, "some words here", "b", "x"), (1, "some words here", "b", "y"), (2, "two words", "a", None)]
    out = pareto_mix.mix(docs(rows, columns), share=100.0).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(str(r) for r in rows for _ in range(pareto_mix.COPIES))
