import random

from quakespark.llm import line_dedup


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    """{(doc_id, line_no): kind} by comparing every line with all earlier ones; doc_ids are unique and in order."""
    gone, before = {}, []
    for doc_id, text in rows:
        for i, line in enumerate((text or "").split("\n") if text is not None else []):
            line = line.strip(" \t\r")
            if not line:
                continue
            if line in before:
                gone[doc_id, i] = "exact"
            elif any(one_edit(line, x) and max(len(line), len(x)) >= line_dedup.MIN_CHARS for x in before):
                gone[doc_id, i] = "near"
            before.append(line)
    return gone


def corpus(seed):
    rng = random.Random(seed)
    letters = "abé漢 x"
    base = ["".join(rng.choice(letters) for _ in range(n)) for n in [*range(12, 40), 100, 333]]
    rows = []
    for doc_id in range(60):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            line = rng.choice(base)
            for _ in range(rng.randrange(0, 3)):
                i = rng.randrange(len(line) + 1)
                line = rng.choice([line[:i] + line[i + 1 :], line[:i] + rng.choice(letters) + line[i:], line[:i] + rng.choice(letters) + line[i + 1 :]])
            lines.append(rng.choice([line, line + " ", "\t" + line + "\r", "", "x"]))
            base.append(line)
        rows.append((doc_id, "\n".join(lines)))
    return rows


def test_against_all_pairs(docs):
    for seed in (1, 2):
        rows = [*corpus(seed), (60, None), (61, ""), (62, "\n\n")]
        want = plain(rows)
        found = line_dedup.repeated_lines(docs(rows)).collect()
        assert {(r.doc_id, r.line_no): r.kind for r in found} == want and len(found) == len(want)
        assert "near" in want.values() and "exact" in want.values()


def test_many_variants_of_one_line(docs):
    """Lines that differ in one place, and insertions everywhere: one earliest line takes them all."""
    base = "record number of the day is here"
    lines = [base] + [base[:9] + chr(0x100 + i) + base[10:] for i in range(300)] + [base[:i] + "#" + base[i:] for i in range(33)]
    rows = [(i, line) for i, line in enumerate(lines)]
    found = {r.doc_id for r in line_dedup.repeated_lines(docs(rows)).collect()}
    assert found == {i for i in range(1, len(lines))}


def test_summary_and_texts(docs):
    rows = [
        (2, "a line of some length here\nown words of two\n\nown words of two"), (1, "a line of some length hero\nlast"),
        (3, "a line of some length hero"), (4, None), (5, ""), (None, "last"), (6, "same same"), (6, "same same"),
    ]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, key int, line_no int, _removed string"
    table = docs(rows, columns)
    out = {(r.doc_id, r.n_lines): (r.n_exact, r.n_near, r.removed) for r in line_dedup.summary(table).collect()}
    assert out[2, 3] == (1, 1, "0,3") and out[1, 2] == (0, 0, "") and out[3, 1] == (1, 0, "0")
    assert out[4, 0] == (0, 0, "") and out[5, 0] == (0, 0, "") and out[None, 1] == (1, 0, "0") and out[6, 1] == (0, 0, "")
    kept = line_dedup.without_repeats(table)
    assert kept.columns == table.columns
    texts = sorted((str(r.doc_id), str(r.text), r.n_chars) for r in kept.collect())
    assert texts == sorted([
        ("2", "own words of two\n", 17), ("1", "a line of some length hero\nlast", None), ("3", "", 0), ("4", "None", None),
        ("5", "", None), ("None", "", 0), ("6", "same same", None), ("6", "same same", None),
    ])


def test_long_text(docs):
    text = "\n".join(f"line {i} of a very long text that repeats after a while" for i in [*range(3000)] * 2)
    kept = line_dedup.without_repeats(docs([(1, text)])).collect()[0].text.split("\n")
    assert kept == [f"line {i} of a very long text that repeats after a while" for i in kept_numbers()]


def kept_numbers():
    """Numbers one edit from a smaller one go."""
    before, kept = [], []
    for i in range(3000):
        s = str(i)
        if not (any(s[:k] + s[k + 1 :] in before_set(before) for k in range(len(s)) if len(s) > 1) or len(s) == 1 and i > 0 or substituted(s, i)):
            kept.append(i)
        before.append(s)
    return kept


def before_set(before):
    return before if len(before) < 50 else _Set(before)


class _Set:
    def __init__(self, items):
        self.n = len(items)

    def __contains__(self, s):
        return s.isdigit() and str(int(s)) == s and int(s) < self.n


def substituted(s, i):
    return any(int(s[:k] + d + s[k + 1 :]) < i and str(int(s[:k] + d + s[k + 1 :])) == s[:k] + d + s[k + 1 :] for k in range(len(s)) for d in "0123456789" if d != s[k])


def test_no_rows(docs):
    assert line_dedup.summary(docs([])).collect() == []
    assert line_dedup.without_repeats(docs([])).collect() == []


def test_short_line_with_two_partners(docs):
    """The earliest partner has 15 characters and does not count; a later one has 16."""
    rows = [(0, "abcdefghijklmnX"), (1, "abcdefghijklmnoY"), (2, "abcdefghijklmno"), (3, "bcdefghijklmno")]
    found = {(r.doc_id, r.line_no): r.kind for r in line_dedup.repeated_lines(docs(rows)).collect()}
    assert found == plain(rows) == {(2, 0): "near"}
