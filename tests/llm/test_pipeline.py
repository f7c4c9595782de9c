"""Every stage on what its predecessor kept, against brute force; entry points."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from cordon.llm import mixing
from cordon.llm.queries import ORACLE, QUERIES
from cordon.llm.shared import cut
from helpers import documents, odd_documents, prose, words
from test_exact_dedup import norm
from test_ngram_join import brute as near_classes
from test_quality_rules import brute as quality


def _rows():
    rng = random.Random(6)
    texts = [prose(rng, rng.randint(40, 120)) for _ in range(60)]
    texts += [t.replace(" ", " ", 1).upper() if rng.random() < 0.3 else t for t in texts[:25]]
    texts += [" ".join(w if k != 30 else "other" for k, w in enumerate(t.split())) for t in texts[:20]]
    texts += ["*** ### " * 40, "same words " * 60, "", None]
    return odd_documents() + [(1000 + i, t, "en", rng.choice(["a", "b", "c", None]), 5) for i, t in enumerate(texts)]


def test_stages_against_brute_force(spark):
    rows = [tuple(r) for r in documents(spark, _rows()).collect()]
    docs = documents(spark, rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = cut(stage(spark, docs, ""), "test-stage")
        got = [tuple(r) for r in out.collect()]
        if k < 4:
            assert out.columns == docs.columns, name
        if k == 0:
            assert Counter(got) == Counter(r for r in rows if quality(r[1])[6])
        elif k == 1:
            top = {}
            for r in rows:
                key = (r[0] is not None, r[0] or 0)
                top[norm(r[1])] = max(top.get(norm(r[1]), key), key)
            assert Counter((norm(r[1]), (r[0] is not None, r[0] or 0)) for r in got) == Counter(top.items())
        elif k == 2:
            assert sorted((r[0] for r in got), key=str) == sorted({c[1] for c in near_classes(rows)}, key=str)
        elif k == 3:
            plan = {r.doc_id: r.copies for r in mixing.mix_rows(docs).collect()}
            assert Counter(got) == Counter(r for r in rows for _ in range(plan[r[0]]))
        else:
            room = defaultdict(int)
            for r in out.collect():
                assert len(r.ids) == 4 * r.length
                room[r.sequence_id] += r.length
            assert max(room.values()) <= 2048
            assert Counter(r.doc_id for r in out.collect() if r.piece == 0) == Counter(r[0] for r in rows)
        rows, docs = got, out


def test_run_gives_the_stages_rows(spark, sf_small):
    rows = corpus_pipeline.run(spark, sf_small).collect()
    kept = {r.doc_id for r in rows}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert kept and all(quality(docs[i])[6] for i in kept)
    assert len({norm(docs[i]) for i in kept}) == len(kept) == len({tuple(words(docs[i])) for i in kept})


def test_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, ""), "test-empty")
        assert docs.count() == 0


def test_sql_has_no_other_queries():
    assert set(ORACLE) <= set(QUERIES)
