import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quakespark.llm import simhash


def plain_fingerprint(text):
    words = [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def plain_components(values, radius=3):
    """Smallest position reachable, by trying all pairs."""
    name = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(len(values)):
                if ((values[i] ^ values[j]) & (1 << 64) - 1).bit_count() <= radius and name[j] < name[i]:
                    name[i], changed = name[j], True
    return name


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbB zé  \t\n\x0b\x1c.İ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_fingerprint_long_text():
    text = " ".join(f"w{i % 977} x{i % 13}" for i in range(30_000))
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def near_values(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.integers(-(2**63), 2**63 - 1, n // 4, dtype=np.int64).tolist()
    out = []
    for _ in range(n):
        v = base[rng.integers(len(base))] if not out or rng.random() < 0.5 else out[rng.integers(len(out))]
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            v ^= 1 << int(b)
        out.append(v - (1 << 64) if v >= 1 << 63 else v + (1 << 64) if v < -(1 << 63) else v)
    return out


@pytest.mark.parametrize("tile", [4096, 5])
def test_links_connect_what_all_pairs_do(spark, tile):
    values = sorted(set(near_values(3, 150)))
    found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp bigint"), tile=tile).collect()
    for row in found:
        assert ((row.a ^ row.b) & (1 << 64) - 1).bit_count() <= 3
    name = {v: v for v in values}
    while any(name[r.a] != name[r.b] for r in found):
        for r in found:
            name[r.a] = name[r.b] = min(name[r.a], name[r.b])
    truth = plain_components(values)
    groups = lambda f: sorted(sorted(v for v in values if f(v) == k) for k in {f(v) for v in values})
    place = dict(zip(values, truth, strict=True))
    assert groups(name.get) == groups(place.get)


def test_one_tile_gives_a_forest():
    values = np.array([0, *(1 << i for i in range(40))], np.uint64)
    a, b = simhash.tile_links(values, None, 3)
    assert len(a) == 40 and len(b) == 40


ROWS = [
    (7, "the quick brown fox jumps over the lazy dog and runs away from here"),
    (3, "THE quick brown fox jumps over the lazy dog and runs away from here"),
    (9, "something else that has nothing to do with any of the other texts"),
    (5, None), (4, ""), (6, " \n "), (None, "the quick brown fox jumps over the lazy dog and runs away from here"),
    (8, "one"), (8, "one"), (None, "a lone text without an id"), (2, "x " * 5000),
]


def test_documents(docs):
    out = simhash.near_duplicates(docs(ROWS)).collect()
    by = sorted((r.doc_id if r.doc_id is not None else -1, r.fp, r.component_id) for r in out)
    truth = plain_components([plain_fingerprint(t) for _, t in ROWS])
    want = []
    for (i, t), k in zip(ROWS, truth, strict=True):
        ids = [j for (j, _), m in zip(ROWS, truth, strict=True) if m == k and j is not None]
        want.append((i if i is not None else -1, plain_fingerprint(t), min(ids, default=None)))
    assert by == sorted(want, key=lambda x: (x[0], x[1]))


def test_one_document_of_each_group_stays(docs):
    columns = "doc_id bigint, text string, lang string, source string, _key int, component_id string, fp string, _n int"
    kept = simhash.one_of_each(docs(ROWS, columns))
    assert kept.columns == [c.split()[0] for c in columns.split(", ")]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "9", "4", "8", "None", "2"])


def test_no_rows(docs):
    assert simhash.near_duplicates(docs([])).collect() == []
    assert simhash.one_of_each(docs([])).collect() == []
