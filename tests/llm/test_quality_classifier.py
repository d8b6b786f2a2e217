"""The compression classifier on held-out labels and odd rows."""

import zlib
from math import exp

import numpy as np
import pytest
import zstandard

from tradeloom.llm.quality import DICTIONARY_BYTES, Model, Scorer, calibrate, curve, dictionary, learn, op7_quality_classifier, score_rows

SF = "/root/testdata/sf0.1"


def area(scores, labels):
    """Chance that a good row scores above a bad one."""
    good, bad = ([s for s, y in zip(scores, labels) if y == v] for v in (1, 0))
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_labels(spark):
    rows = {r.doc_id: r for r in op7_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(rows[r.doc_id], r.quality) for r in labels if rows[r.doc_id].held_out]
    assert area([r.score for r, _ in held], [q for _, q in held]) > 0.97
    good = [r.predicted for r, q in held if q == 1]
    bad = [r.predicted for r, q in held if q == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35


def test_labels_of_held_out_rows_change_nothing(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(string(doc_id) as binary)) % 5 = 0, 1 - quality, quality) AS quality")
    assert learn(documents, labels) == learn(documents, turned)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "word " * 50_000, "y"), (2, "same", "z"), (2, "same", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    model = Model(b"good words of prose " * 20, b"### *** $$$ %%% " * 20, 9.0, 0.5)
    found = score_rows(df, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert found[0].score == found[1].score == pytest.approx(curve(0.0, 9.0, 0.5))
    assert score_rows(df.limit(0), model).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in score_rows(df, learn(df, none)).collect()} == {0.5}
    one_kind = spark.createDataFrame([(2, 1), (7, 1), (7, None), (None, 0)], "doc_id bigint, quality int")
    assert all(0 <= r.score <= 1 for r in score_rows(df, learn(df, one_kind)).collect())


def test_calibration_finds_the_curve():
    rng = np.random.default_rng(1)
    x = rng.normal(size=20_000)
    y = (rng.random(20_000) < curve(x, 3.0, -1.0)).astype(float)
    assert calibrate(x, y, np.ones(len(x))) == pytest.approx((3.0, -1.0), abs=0.15)


def test_long_texts_are_scored_like_short_ones(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    scorer = Scorer(learn(documents, labels))
    held = documents.join(labels, "doc_id").filter("crc32(cast(string(doc_id) as binary)) % 5 = 0").orderBy("doc_id")
    rows = held.select("text", "quality").collect()
    for quality in (0, 1):
        texts = [r.text for r in rows if r.quality == quality and r.text]
        joined = " ".join(texts)

        def parts(size):
            return [joined[i : i + size] for i in range(0, len(joined) - size + 1, size)]

        short = np.mean([scorer.difference(t) for t in parts(2000)])
        for size in (50_000, 200_000):
            assert np.mean([scorer.difference(t) for t in parts(size)]) == pytest.approx(short, rel=0.3)
            assert np.mean([scorer.score(t) >= 0.3 for t in parts(size)]) == quality


def test_whole_labelled_texts_are_learned(spark):
    rows = [(i, ("good prose here " if i % 2 else "### $$$ %%% ") * 300 + ("late words of praise " if i % 2 else "late @@@ && ") * 2000) for i in range(40)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    model = learn(documents, labels)
    for part in (b"good prose here", b"late words of praise"):
        assert part in model.good
    assert b"###" in model.bad and b"late @@@" in model.bad


def test_scores_against_plain_compression(spark):
    """Every document by itself: pieces of the text, a new compressor for each, and the curve."""
    small = "/root/testdata/sf0.001"
    documents, labels = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "labels"))
    model = learn(documents, labels)
    texts = {r.doc_id: r.text for r in documents.collect()}

    def compressed(piece, content):
        return len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content)).compress(piece))

    for r in op7_quality_classifier(spark, small).collect():
        data = (texts[r.doc_id] or "").encode()
        n = (len(data) + 1999) // 2000
        cuts = [len(data) * i // n for i in range(n + 1)] if n else [0]
        saved = sum(compressed(data[a:b], model.bad) - compressed(data[a:b], model.good) for a, b in zip(cuts, cuts[1:]))
        score = 1 / (1 + exp(-(model.slope * saved / max(len(data), 1) + model.offset)))
        assert r.score == pytest.approx(score, rel=1e-3, abs=1e-3)


def test_dictionaries_leave_out_no_text():
    short = [f"text number {i} of a few words" for i in range(40)]
    assert all(t.encode() in dictionary(short) for t in short)
    # few texts, far longer than the dictionary: chosen from all of them
    rng = np.random.default_rng(2)
    phrases = ["".join(rng.choice(list("abcdefghijklmnop"), 40)) for _ in range(50)]
    chosen = dictionary(["".join(rng.choice(list("abcdefgh "), 6000)) + f" {phrase} " * 200 for phrase in phrases])
    assert len(chosen) <= DICTIONARY_BYTES
    assert sum(phrase.encode() in chosen for phrase in phrases) >= 45
