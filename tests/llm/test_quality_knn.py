"""kNN quality: exact neighbours against brute force, held-out accuracy, edge cases."""

import random

import numpy as np
import pyarrow as pa

from cordon.llm import quality_knn as knn
from cordon.llm.queries import op2_quality_knn
from cordon.llm.words import slices
from helpers import documents, odd_documents, prose, rows_of, with_clashes


def _labelled(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = prose(rng, rng.randint(20, 200))
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split()) if i % 2 else " | ".join(text.split())
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(good), 0))
    return rows, labels


def test_blocked_scores_equal_a_plain_loop(monkeypatch):
    rows, labels = _labelled(300)
    raw = np.concatenate([knn.features(t) for t in slices(pa.array([r[1] for r in rows]))])
    y = np.array([q for _, q, _ in labels])
    m = knn.fit_rows(raw[:200], y[:200], (int((y[:200] == 0).sum()), int((y[:200] == 1).sum())))
    vectors = m.vectors_of(raw[200:])
    want = []
    for v in vectors:
        near = m.vectors @ v
        top = np.argsort(near)[-knn.NEIGHBOURS:]
        w = np.maximum(near[top], 0).astype(float) ** 8 * m.vote[m.labels[top]]
        want.append((w * m.labels[top]).sum() / w.sum())
    monkeypatch.setattr(knn, "DOCS_AT_ONCE", 7)
    assert np.allclose(m.score(raw[200:]), want, atol=1e-4)


def test_held_out_accuracy_and_ignored_columns(spark):
    rows, labels = _labelled(600)
    df = with_clashes(documents(spark, rows))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = knn.fit(df, lab.filter("doc_id % 3 <> 0"))
    got = {r.doc_id: r for r in knn.score(df, model).collect()}
    truth = {i: q for i, q, _ in labels}
    held = [i for i in truth if i % 3 == 0]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    again = {r.doc_id: r.score for r in knn.score(df.selectExpr("doc_id", "text", "'x' AS lang"), model).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-6 for i in got)


def test_registered_query_on_the_small_tables(spark, sf_small):
    import zlib

    rows = {r.doc_id: r for r in op2_quality_knn(spark, sf_small).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    labels = [r for r in spark.read.parquet(f"{sf_small}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert np.mean([rows[r.doc_id].predicted == r.quality for r in labels]) > 0.9


def test_edge_cases(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = knn.fit(documents(spark), none)
    assert {r.score for r in knn.score(documents(spark), model).collect()} == {0.5}
    odd = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, 0, 0), (None, 0, 0), (2, None, 0), (999, 0, 0), (9, 0, 1)],
                                "doc_id long, quality int, toxic int")
    df = with_clashes(documents(spark))
    got = knn.score(df, knn.fit(df, odd)).collect()
    assert len(got) == len(odd_documents()) and all(0 <= r.score <= 1 for r in got)
    assert rows_of(knn.score(documents(spark, []), model)) == []


def test_document_frequencies_are_of_all_documents(spark):
    rows, labels = _labelled(200)
    rows += [(1000 + i, f"unlabelled words {i}", None, None, None) for i in range(50)] + odd_documents()
    df = with_clashes(documents(spark, rows)).repartition(3)
    lab = spark.createDataFrame(labels[:60], "doc_id long, quality int, toxic int")
    raw = np.concatenate([knn.features(t) for t in slices(pa.array([r[1] for r in rows], pa.string()))])
    want = np.log((1 + len(rows)) / (1 + (raw > 0).sum(axis=0))) + 0.1
    assert np.allclose(knn.fit(df, lab).idf, want, atol=1e-5)
