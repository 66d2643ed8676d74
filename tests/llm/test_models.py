import math
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from quakespark.llm import language, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SOUNDS = {"aa": ["ka", "to", "mi", "ru", "no"], "bb": ["sch", "ein", "ung", "lich", "ver"], "cc": ["eau", "que", "ré", "oi", "tion"]}


def speech(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def held_out(i, parts, which):
    return zlib.crc32(str("" if i is None else i).encode()) % parts == which


def plain_log_probability(word, p, pieces, k):
    """Sum over every segmentation, one by one."""
    text = "▁" + word

    def total(at):
        if at == len(text):
            return 1.0
        out = 0.0
        for end in range(at + 1, min(len(text), at + language.LONGEST) + 1):
            i = pieces.get(text[at:end], 0)
            if i or end == at + 1:
                out += p[i, k] * total(end)
        return out

    return math.log(total(0))


def test_forward_sums_all_segmentations():
    pieces = language._pieces(PIECES)
    rng = np.random.default_rng(0)
    p = rng.random((len(pieces) + 1, 2))
    p /= p.sum(0)
    model = language.Model(PIECES, ["x", "y"], p)
    words = ["a", "the", "nation", "été", "漢字", "lichkeit", "zzzz"]
    got = model.words(words)
    for word, row in zip(words, got, strict=True):
        assert row == pytest.approx([plain_log_probability(word, p, pieces, k) for k in range(2)])
    assert np.isfinite(model.words(["ab" * 5000])).all()


def test_expectation_counts_whole_words():
    """Expected uses cover each word's length exactly once, and learning raises the likelihood."""
    pieces = language._pieces(PIECES)
    words = ["nation", "national", "the"]
    lengths = np.array([0] * (len(pieces) + 1))
    for piece, i in pieces.items():
        lengths[i] = len(piece)
    lengths[0] = 1
    p = np.full((len(pieces) + 1, 1), 1 / (len(pieces) + 1))
    for index, part in language._by_length(words):
        used = np.zeros_like(p)
        language._Lattice(part, pieces).expect(language._padded(p), np.ones((len(part), 1)), used)
        assert (used[:, 0] * lengths).sum() == pytest.approx(sum(len(w) + 1 for w in part))
    counts = pd.DataFrame({"lang": ["x"] * 3, "word": words, "n": [5, 3, 9]})
    score = [float((language.fit(counts, PIECES, r).words(words)[:, 0] * [5, 3, 9]).sum()) for r in (1, 2, 4)]
    assert score == sorted(score)


def test_language_of_documents(docs):
    rng = random.Random(4)
    rows = [(i, speech(rng, lang := rng.choice(list(SOUNDS)), rng.randrange(3, 60)), lang, "s") for i in range(150)]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 ... !", "cc"), (203, speech(rng, "bb", 20), None), (None, speech(rng, "cc", 9000), "cc"), (rows[0][0], rows[0][1], rows[0][2])]
    columns = "doc_id bigint, text string, lang string, source string, lang_pred int, score string, held_out string"
    out = language.identify(docs(rows, columns), PIECES).collect()
    assert len(out) == len(rows)
    text = {r[0]: r for r in rows}
    for r in out:
        assert r.held_out == held_out(r.doc_id, 5, 0) and 0 <= r.score <= 1
    assert {r.lang_pred for r in out if r.doc_id in (200, 201, 202)} == {"und"}
    checked = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 150]
    assert sum(text[r.doc_id][2] == r.lang_pred for r in checked) >= 0.95 * len(checked) > 10
    assert {r.lang_pred for r in out if r.doc_id == 203} == {"bb"}


def test_language_without_rows_or_labels(docs):
    assert language.identify(docs([]), PIECES).collect() == []
    out = language.identify(docs([(1, "some words"), (2, "others")]), PIECES).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)] * 2


def test_languages_are_not_read(docs):
    rng = random.Random(8)
    rows = [(i, speech(rng, lang := rng.choice(list(SOUNDS)), 30), lang) for i in range(60)]
    other = [(i, t, "cc" if held_out(i, 5, 0) else lang) for i, t, lang in rows]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs(x), PIECES).collect()} for x in (rows, other))
    assert a == b


def insulted(rng, text):
    words = text.split(" ")
    for _ in range(2):
        words.insert(rng.randrange(len(words) + 1), rng.choice(["grobian", "grobiane", "fiend", "lout"]))
    return " ".join(words)


def toxic_rows(n=700):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        text, bad = speech(rng, lang := rng.choice(list(SOUNDS)), rng.randrange(5, 120)), rng.random() < 0.25
        rows.append((i, insulted(rng, text) if bad else text, lang, "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity(spark, docs):
    rows, labels = toxic_rows()
    extra = [(900, None), (901, ""), (902, "..."), (None, "word " * 70_000 + "grobian"), (0, rows[0][1], rows[0][2])]
    columns = "doc_id bigint, text string, lang string, source string, score string, toxic int, held_out int"
    more = [(901, None, None), (None, 1, 1), (5000, 0, 1), labels[3]]
    frame, marks = docs([*rows, *extra], columns), label_table(spark, [*labels, *more])
    out = toxicity.scores(frame, marks).collect()
    assert len(out) == len(rows) + len(extra)
    truth = {i: t for i, _, t in labels}
    hits = [(truth[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in truth]
    good = sum(a == b == 1 for a, b in hits)
    assert good >= 0.9 * sum(a for a, _ in hits) > 10 and good >= 0.9 * sum(b for _, b in hits)
    for r in out:
        assert r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    assert {r.predicted for r in out if r.doc_id in (900, 901, 902)} == {0}
    # labels and languages of the held-out fold change nothing
    flipped = [(i, q, 1 - t if t is not None and held_out(i, 3, 1) else t) for i, q, t in [*labels, *more]]
    moved = docs([(r[0], r[1], "aa" if held_out(r[0], 3, 1) else (*r, None)[2]) for r in [*rows, *extra]])
    again = toxicity.scores(moved, label_table(spark, flipped)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in out}


def test_toxicity_without_labels(spark, docs):
    rows, _ = toxic_rows(30)
    assert {r.predicted for r in toxicity.scores(docs(rows), label_table(spark, [])).collect()} == {0}
    assert {r.predicted for r in toxicity.scores(docs(rows), label_table(spark, [(i, 1, 1) for i in range(30)])).collect()} == {1}
    assert toxicity.scores(docs([]), label_table(spark, [(1, 1, 1)])).collect() == []


def test_every_labelled_document_is_learned_from(spark, docs):
    """Each text has a word of its own, which its language has to know."""
    rng = random.Random(9)
    rows = [(i, f"word{i} " + ("grobian" if i % 20 == 0 else "friend"), rng.choice(["aa", "bb"]), "s") for i in range(6000)]
    model = toxicity.train(docs(rows), label_table(spark, [(i, 1, int(i % 20 == 0)) for i in range(6000)]))
    memory = toxicity._Buckets()
    unseen = model.languages.min(0)
    for i, text, lang, _ in rows:
        assert model.languages[toxicity.buckets_of(text, memory)[0, 0], "ab".index(lang[0])] > unseen["ab".index(lang[0])], i


def test_parts_learn_side_by_side(spark, docs, monkeypatch):
    monkeypatch.setattr(toxicity, "PART_DOCS", 100)
    rows, labels = toxic_rows(2000)
    out, again = (toxicity.scores(docs(rows), label_table(spark, labels)).collect() for _ in range(2))
    assert {r.doc_id: r.score for r in out} == {r.doc_id: r.score for r in again}
    truth = {i: t for i, _, t in labels}
    hits = [(truth[r.doc_id], r.predicted) for r in out if r.held_out]
    good = sum(a == b == 1 for a, b in hits)
    assert good >= 0.9 * sum(a for a, _ in hits) > 10 and good >= 0.9 * sum(b for _, b in hits)


def test_sliced_text_scores_as_a_whole(monkeypatch):
    rows, labels = toxic_rows(300)
    memory = toxicity._Buckets()
    texts = [toxicity.buckets_of(t, memory) for _, t, *_ in rows]
    model = toxicity.fit(texts, np.array([t for *_, t in labels]), [r[2] for r in rows], epochs=4)
    whole = [model.logit(t) for t in texts[:60]]
    monkeypatch.setattr(toxicity, "_SLICE", 7)
    assert [model.logit(t) for t in texts[:60]] == pytest.approx(whole)


def test_no_usable_piece_is_too_long():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    all_pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    usable = {p for p in all_pieces if p == p.lower() and language._LETTERS.fullmatch(p.removeprefix("▁") or "a")}
    pieces = language._pieces(PIECES)
    assert usable == set(pieces) and "▁international" in usable
    p = np.random.default_rng(1).random((len(pieces) + 1, 1))
    p /= p.sum(0)
    got = language.Model(PIECES, ["x"], p).words(["international"])
    assert got[0] == pytest.approx([plain_log_probability("international", p, pieces, 0)])
