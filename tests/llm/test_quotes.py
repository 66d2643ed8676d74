import random
import re

import duckdb
import pytest

from quakespark.llm import queries, quotes

COLUMNS = "conv_id bigint, turn bigint, role string, text string, depth string, position int, key string"
MARKS = re.compile(r"^((?:[ \t]*>)+)")


def norm(text):
    return re.sub(r"\s+", " ", text.lower()).strip()


def parse(text):
    """Own text, and (level, passage) of what is quoted."""
    own, runs, last = [], [], 0
    lines = (text or "").split("\n")
    for i, line in enumerate(lines):
        m = MARKS.match(line)
        level = m[1].count(">") if m else 0
        if not level:
            follows = i + 1 < len(lines) and MARKS.match(lines[i + 1])
            if not (follows and re.match(r"(?i)^[ \t]*on\b.*\bwrote\b.*:[ \t\r]*$", line)):
                own.append(line)
        elif level == last:
            runs[-1][1].append(line[m.end():])
        else:
            runs.append((level, [line[m.end():]]))
        last = level
    passages = {(lv, norm(p)) for lv, body in runs for p in [" ".join(body), *body] if len(norm(p)) >= quotes.LEAST}
    joined = "\n".join(own)
    return (joined.strip() if runs else joined), passages


def said(text):
    own = parse(text)[0]
    return {norm(p) for p in [*re.split(r"\n[ \t\r]*\n", own), *own.split("\n")] if len(norm(p)) >= quotes.LEAST}


def plain(rows):
    """{(conv_id, turn): (parent, root, depth)} by looking through all messages; (conv_id, turn) is unique."""
    parents = {}
    for c, t, _, text in rows:
        if c is None or t is None:
            continue
        votes = {}
        for level, p in parse(text)[1]:
            holders = sorted((a, b) for a, b, _, x in rows if a is not None and b is not None and p in said(x))
            near, far = [h for h in holders if h[0] == c], holders[:1]
            of = next((h for h in [*near[:1], *far] if h < (c, t)), None)
            if of:
                votes[level, of] = votes.get((level, of), 0) + len(p)
        if votes:
            parents[c, t] = max(votes, key=lambda v: (-v[0], votes[v], v[1]))[1]
    out = {}
    for c, t, *_ in rows:
        at, depth = (c, t), 0
        while at in parents:
            at, depth = parents[at], depth + 1
        out[c, t] = (parents.get((c, t)), at[0], depth)
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = []
    for c in range(6):
        for t in range(12):
            mine = "\n".join(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(0, 4)))
            if rows and rng.random() < 0.7:
                of = rng.choice([r for r in rows if r[0] == c] or rows) if rng.random() < 0.8 else rng.choice(rows)
                quoted = parse(of[3])[0].split("\n")[: rng.randrange(1, 4)]
                mark = rng.choice(["> ", ">", " > "])
                mine = "On Monday X wrote:\n" + "\n".join((mark + q).upper() if rng.random() < 0.2 else mark + q for q in quoted) + "\n\n" + mine
            rows.append((c, t, "user", mine))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_messages(spark, seed):
    rows = corpus(seed) + [(9, 0, None, None), (9, 1, "user", ""), (9, 2, "user", "> nobody ever said this thing")]
    full = [(*r, "x", 1, "k") for r in rows]
    out = quotes.conversations(spark.createDataFrame(full, COLUMNS).repartition(4)).collect()
    want = plain(rows)
    assert len(out) == len(rows) and any(p for p, *_ in want.values()) and max(d for *_, d in want.values()) >= 3
    threads = {}
    for r in out:
        text = next(x for c, t, _, x in rows if (c, t) == (r.conv_id, r.turn))
        assert r.text == parse(text)[0]
        reply = (r.reply_conv, r.reply_turn) if r.reply_conv is not None else None
        assert (reply, r.thread_conv, r.depth) == want[r.conv_id, r.turn]
        assert r.n_quoted == sum(bool(MARKS.match(x)) for x in (text or "").split("\n"))
        threads.setdefault(r.thread_conv, []).append((r.position, r.conv_id, r.turn))
    for found in threads.values():
        found.sort()
        assert [p for p, *_ in found] == list(range(len(found))) and [f[1:] for f in found] == sorted(f[1:] for f in found)


def test_against_sql(spark, tmp_path):
    rows = [
        *corpus(3), *corpus(3)[:1], (None, 0, "user", "> nobody ever said this thing"), (9, 0, None, None), (9, 1, "user", ""),
        (9, 2, "user", ">>\u00a0Twice\tquoted words \n>> here and there\n> and once\r\n\n mine, twice quoted words here and there\n"),
        (9, 3, "user", "twice quoted words here and there\r> no quote"), (10, 0, "user", " >Mine, twice quoted words here and there"),
    ]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op1_quotation_linking(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cur = con.execute(queries.ORACLES["op1_quotation_linking"])
    names = [d[0] for d in cur.description]
    order = lambda rs: sorted((tuple(r) for r in rs), key=str)
    assert sorted(names) == sorted(got.columns)
    assert order(got.select(*names).collect()) == order(cur.fetchall())


def test_levels_and_repeats(spark):
    rows = [
        (1, 0, "user", "the first thing I have to say"),
        (1, 1, "assistant", "> the first thing\n> I have to say\n\nindeed, this is an answer"),
        (1, 2, "user", ">> The first   thing I have to say\n> indeed, this is an answer\nand mine"),
        (1, 2, "user", ">> The first   thing I have to say\n> indeed, this is an answer\nand mine"),
        (None, 0, "user", "> the first thing I have to say"), (2, None, "user", "> indeed, this is an answer\nx"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1, "k") for r in rows], COLUMNS)
    out = quotes.conversations(frame).collect()
    assert len(out) == 6
    by = {(r.conv_id, r.turn): r for r in out}
    assert (by[1, 1].reply_turn, by[1, 1].depth, by[1, 1].text) == (0, 1, "indeed, this is an answer")
    assert (by[1, 2].reply_turn, by[1, 2].depth, by[1, 2].max_level, by[1, 2].n_links, by[1, 2].text) == (1, 2, 2, 2, "and mine")
    assert by[None, 0].reply_conv is None and by[2, None].reply_conv is None and by[None, 0].thread_conv is None


def test_everybody_quotes_one_line(spark):
    line = "a line that everybody quotes"
    rows = [(0, 0, "user", line)] + [(i % 5, 1 + i, "user", f"> {line}\n\nanswer number {i}\n{line}") for i in range(300)]
    out = quotes.conversations(spark.createDataFrame([(*r, "x", 1, "k") for r in rows], COLUMNS).repartition(5)).collect()
    for r in out:
        if r.conv_id == 0 and r.turn:
            assert (r.reply_conv, r.reply_turn) == (0, 0)
    assert all(r.reply_conv is not None for r in out if (r.conv_id, r.turn) != (0, 0))


def test_no_rows_and_plan(spark):
    frame = spark.createDataFrame([], COLUMNS)
    out = quotes.conversations(frame)
    assert out.collect() == []
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_long_message(spark):
    text = "\n".join(f"> line number {i} of a long quote" for i in range(20_000)) + "\nown words"
    frame = spark.createDataFrame([(1, 0, "user", text, "x", 1, "k")], COLUMNS)
    row = quotes.conversations(frame).collect()[0]
    assert (row.text, row.n_quoted) == ("own words", 20_000)


def test_rewrapped_paragraphs(spark):
    one, two, three = "the first paragraph is long enough to wrap", "and the second one follows after it", "a third ends the message"
    rows = [
        (1, 0, "user", f"{one}\n\n{two}\n \n{three}"),
        (1, 1, "assistant", "> the first paragraph is\n> long enough to wrap\n>\n> and the second one\n> follows after it\n\nyes"),
        (1, 2, "assistant", ">the first paragraph is\n>long enough to wrap\n> \n>\n>and the second one\n>follows after it\n>\t\n>a third ends\n>the message\nno"),
        (1, 3, "user", "> the second\n>\n> one nobody said this"),
        (2, 0, "user", "short one\n\ntwo words\n\nby me"), (3, 0, "user", "> short\n> one\n>\n> two\n> words\n>\n> by\n> me"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1, "k") for r in rows], COLUMNS)
    by = {(r.conv_id, r.turn): r for r in quotes.conversations(frame).collect()}
    for at in ((1, 1), (1, 2)):
        assert (by[at].reply_conv, by[at].reply_turn, by[at].thread_conv, by[at].depth, by[at].n_links) == (1, 0, 1, 1, 1)
    assert by[1, 3].reply_conv is None
    assert (by[3, 0].reply_conv, by[3, 0].reply_turn) == (2, 0)


def test_whole_messages_of_short_paragraphs(spark):
    """No paragraph and no line is long enough; the whole message is."""
    rows = [(1, 0, "user", "one two\n\nthree\n\nfour"), (1, 1, "user", "> one\n> two\n>\n> three\n>\n> four\nyes")]
    frame = spark.createDataFrame([(*r, "x", 1, "k") for r in rows], COLUMNS)
    by = {(r.conv_id, r.turn): r for r in quotes.conversations(frame).collect()}
    assert (by[1, 1].reply_conv, by[1, 1].reply_turn) == (1, 0)
