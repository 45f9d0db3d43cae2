import zlib

import numpy as np

from locus.llm.quality import Model, calibrate, classify, keep_good, probabilities

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(prose, n=400):
    good = prose(n, 60, vocabulary=300)
    bad = [(f"junk{k % 5}### " * 40).strip() for k in range(n // 4)]
    rows = list(enumerate(good + bad))
    return rows, [(i, int(i < n), 0, "clashes") for i, _ in rows]


def test_held_out_accuracy_and_columns(spark, frame, prose):
    rows, labels = corpus(prose)
    got = classify(frame(rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: q for i, q, *_ in labels}
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_labels_of_held_out_rows_are_not_learnt(spark, frame, prose):
    rows, labels = corpus(prose, 200)
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t, x) for i, q, t, x in labels]
    score = lambda ls: sorted((r.doc_id, r.score) for r in classify(frame(rows), spark.createDataFrame(ls, LABELS)).collect())
    assert score(labels) == score(other)


def test_odd_rows_odd_labels_and_empty_tables(spark, frame, odd):
    for labels in ([], [(None, 1, 0, ""), (4, None, 0, "")], [(4, 1, 0, ""), (4, 0, 0, ""), (4, 1, 0, ""), (99, 0, 0, "")], [(i, 1, 0, "") for i in range(9)]):
        got = classify(frame(odd), spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert classify(frame([]), spark.createDataFrame([], LABELS)).count() == 0


def test_no_labels_score_a_half(spark, frame, odd):
    assert {r.score for r in classify(frame(odd), spark.createDataFrame([], LABELS)).collect()} == {0.5}


def test_equal_texts_equal_scores_and_keep_good_keeps_columns(spark, frame, prose):
    rows, labels = corpus(prose, 200)
    docs = frame([*rows, (5000, rows[3][1]), (5001, rows[-1][1])])
    labels = spark.createDataFrame(labels, LABELS)
    score = {r.doc_id: r.score for r in classify(docs, labels).collect()}
    assert score[5000] == score[3] and score[5001] == score[rows[-1][0]]
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {i for i, s in score.items() if s >= 0.5}


def test_calibration_is_a_likelihood():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.5)))
    y = (rng.random(4000) < p).astype(float)
    calibrate(x, y, model := Model())
    assert np.abs(probabilities(x, model) - p).mean() < 0.03
