import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quakespark.llm import setsketch

HASHES = setsketch._Words()


def plain_set(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < k:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}


def plain(docs, k=3, at_least=(85, 100)):
    """(doc_id, n_shingles, component_id, kept) by all pairs."""
    sets = [plain_set(t, k) for _, t in docs]
    name = list(range(len(docs)))
    links = [
        (i, j) for i, j in itertools.combinations(range(len(docs)), 2)
        if sets[i] and at_least[1] * len(sets[i] & sets[j]) >= at_least[0] * len(sets[i] | sets[j])
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            if name[i] != name[j]:
                name[i] = name[j] = min(name[i], name[j])
                changed = True
    out = []
    for (i, _), s, n in zip(docs, sets, name, strict=True):
        ids = [d for (d, t), m in zip(docs, name, strict=True) if m == n and d is not None]
        c = min(ids, default=None) if s else i
        out.append((i, len(s), c, c is not None and i == c))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_texts(seed, families, each, changes):
    """Families of texts that differ from each other, and from earlier members, in some words."""
    rng = np.random.default_rng(seed)
    out = []
    for f in range(families):
        base = [f"w{rng.integers(400)}" for _ in range(rng.integers(60, 120))]
        members = [base]
        for _ in range(each - 1):
            words = list(members[rng.integers(len(members))])
            for at in rng.integers(0, len(words), rng.integers(0, changes)):
                words[at] = f"v{rng.integers(10**6)}"
            members.append(words)
        out += [" ".join(m) for m in members]
    order = rng.permutation(len(out))
    return [(int(i), out[o]) for i, o in enumerate(order, 100)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="aAbB zé  \t\n\x0b\x1c.İ", max_size=60), st.integers(1, 4))
def test_set_size(text, k):
    assert len(setsketch.shingle_set(text, k, HASHES)) == len(plain_set(text, k))


def test_set_of_a_long_text():
    text = " ".join(f"w{i % 977} x{i % 13}" for i in range(60_000))
    assert len(setsketch.shingle_set(text, 3, HASHES)) == len(plain_set(text))


def test_equal_sets_have_equal_hashes():
    one, other = (setsketch.shingle_set(t, 3, setsketch._Words()) for t in ("a b c A B C a b c", "b c a b c a b"))
    assert one.tolist() == other.tolist() and len(one) == 3


@pytest.mark.parametrize("parts", [[5, 7], [1, 3000], [900, 900, 1]])
def test_registers_merge(parts):
    rng = np.random.default_rng(len(parts))
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in parts]
    merged = np.maximum.reduce([setsketch.registers(s, 96) for s in sets])
    assert (merged == setsketch.registers(np.concatenate(sets), 96)).all()


def test_registers_are_spaced_by_powers():
    """A register names a power of the base just above the smallest variate; those of n members are exponential with rate n."""
    rng = np.random.default_rng(4)
    n, m = 2000, 3000
    k = setsketch.registers(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2), m).astype(float)
    variates = setsketch.BASE ** (1 - k) * setsketch.RATE * n
    assert abs(variates.mean() - 1) < 0.08
    assert abs(np.median(variates) - np.log(2)) < 0.08


@pytest.mark.parametrize("similarity", [0.3, 0.6, 0.85, 0.95])
def test_agreement_and_estimate(similarity):
    rng = np.random.default_rng(7)
    n, m = 1000, 180
    both = int(similarity * n)
    agree, kept = [], []
    for _ in range(40):
        x = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)
        a, b = x[: both + (n - both) // 2], np.r_[x[:both], x[both + (n - both) // 2 :]]
        ra, rb = setsketch.registers(a, m), setsketch.registers(b, m)
        agree.append((ra == rb).mean())
        counts = [np.array([v]) for v in ((ra > rb).sum(), (ra < rb).sum())]
        kept.append(setsketch.possible(*counts, m, np.array([len(a)]), np.array([len(b)]), (85, 100))[0])
    assert abs(np.mean(agree) - similarity) < 0.03
    assert all(kept) if similarity >= 0.85 else sum(kept) <= 2


def test_bands_miss_little():
    for at_least in ((85, 100), (80, 100), (1, 2)):
        s = at_least[0] / at_least[1]
        assert (1 - s**setsketch.ROWS) ** setsketch.bands(at_least) <= setsketch.MISS


def test_sizes_that_forbid_a_link():
    out = setsketch.possible(np.array([0, 0]), np.array([0, 0]), 60, np.array([84, 85]), np.array([100, 100]), (85, 100))
    assert out.tolist() == [False, True]


def test_exact_bound():
    a = np.arange(100, dtype=np.uint64)
    assert setsketch.alike(a[:85], a, (85, 100)) and not setsketch.alike(a[:84], a, (85, 100))
    assert not setsketch.alike(a[:0], a, (85, 100)) and not setsketch.alike(a[:0], a[:0], (85, 100))


ROWS = [
    (7, "one two three four five six seven eight nine ten"), (3, "ONE two three four five six seven eight nine ten"),
    (9, "something else that has nothing to do with any of the other texts"), (5, None), (4, ""), (6, " \n\x0b "), (2, "x " * 5000),
    (None, "one two three four\tfive six seven eight nine ten"), (8, "one"), (8, "one"), (1, "one"), (8, "another text under one id"),
    (None, "a lone text without an id"), (None, None), (11, "one two"), (12, "two one"), (13, "one two\n"), (14, "x x x"),
]


def test_odd_rows(docs):
    columns = "doc_id bigint, text string, rid int, key int, node string, n int, component_id string, digest int, registers int"
    table = docs(ROWS, columns)
    assert found(setsketch.near_duplicates(table, 3, (85, 100))) == plain(ROWS)


def test_families(docs):
    rows = near_texts(3, 6, 9, 5)
    truth = plain(rows)
    assert 6 < len({r[2] for r in truth}) < len(rows)
    assert found(setsketch.near_duplicates(docs(rows), 3, (85, 100))) == truth


def test_without_leaders_in_small_tiles(docs, monkeypatch):
    monkeypatch.setattr(setsketch, "ROUNDS", 0)
    monkeypatch.setattr(setsketch, "TILE", 3)
    monkeypatch.setattr(setsketch, "TILE_SHINGLES", 400)
    rows = near_texts(5, 3, 12, 6)
    assert found(setsketch.near_duplicates(docs(rows), 3, (85, 100))) == plain(rows)


def test_large_components_apart_in_a_bucket(docs, monkeypatch):
    monkeypatch.setattr(setsketch, "ROUNDS", 1)
    monkeypatch.setattr(setsketch, "TILE", 2)
    monkeypatch.setattr(setsketch, "TILE_SHINGLES", 150)
    rows = near_texts(11, 1, 36, 9)
    truth = plain(rows, 3, (80, 100))
    assert len({r[2] for r in truth}) > 1
    assert found(setsketch.near_duplicates(docs(rows), 3, (80, 100))) == truth


def test_shingles_of_five_by_default(docs):
    rows = near_texts(2, 3, 5, 3)
    assert found(setsketch.near_duplicates(docs(rows))) == plain(rows, 5, (80, 100))


def test_no_rows(docs):
    assert setsketch.near_duplicates(docs([])).collect() == []


def test_only_empty_texts(docs):
    assert found(setsketch.near_duplicates(docs([(1, None), (2, ""), (1, " ")]))) == plain([(1, None), (2, ""), (1, " ")])
