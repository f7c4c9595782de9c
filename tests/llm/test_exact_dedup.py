"""Exact deduplication against plain Python, with forced bucket bounds inside groups of copies."""

import hashlib
import random
from collections import defaultdict

import pytest

from cordon.llm import exact_dedup, ranges
from helpers import documents, odd_documents, rows_of, with_clashes


def norm(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def check(spark, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    got = exact_dedup.exact_groups(with_clashes(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    kept = defaultdict(int)
    for r in got:
        ids = [i for i in by_hash[r.text_sha256] if i is not None]
        top = max(ids) if ids else exact_dedup.LEAST
        assert r.group_size == len(by_hash[r.text_sha256])
        assert r.keep_id == (top if ids else None) or (not ids and r.keep_id in (None, exact_dedup.LEAST))
        if r.kept:
            kept[r.text_sha256] += 1
            assert r.doc_id == (top if ids else None)
    assert set(kept) == set(by_hash) and set(kept.values()) == {1}


def test_odd_documents(spark):
    check(spark, odd_documents())


@pytest.mark.parametrize("seed", range(3))
def test_random_groups(spark, seed):
    rng = random.Random(seed)
    shared = "the same beginning of many texts, longer than the key is, so that keys are equal "
    texts = [shared + str(rng.randint(0, 9)) for _ in range(10)] + ["Hot text"] * 3 + ["", None, "é", "É", "A", "a"]
    rows = [(rng.choice([None, rng.randint(0, 400)]), rng.choice(texts), None, None, rng.randint(0, 2)) for _ in range(600)]
    check(spark, rows)


def test_keep_one_keeps_whole_rows(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, rng.randint(0, 50)]), rng.choice(["x", "X", "y", None, "", "hot"]), "l", "s", rng.randint(0, 1))
            for _ in range(400)]
    df = with_clashes(documents(spark, rows))
    kept = exact_dedup.keep_one(df)
    assert kept.columns == df.columns
    got = {norm(r.text): r.doc_id for r in kept.collect()}
    assert kept.count() == len(got) == 4
    for k in got:
        assert got[k] == max(r[0] for r in rows if norm(r[1]) == k and r[0] is not None)


def test_empty_table(spark):
    assert rows_of(exact_dedup.exact_groups(documents(spark, []))) == []
    assert rows_of(exact_dedup.keep_one(documents(spark, []))) == []


def test_buckets_are_even_within_one_text(spark):
    df = spark.range(20_000).selectExpr("id AS doc_id", "'one text' AS text")
    from pyspark.sql import functions as F

    cuts = ranges.sampled_splitters(df, F.col("text"), F.col("doc_id"), 20_000)
    n = df.select(ranges.bucket_of(F.col("text"), F.col("doc_id"), cuts).alias("b")).groupBy("b").count().collect()
    assert len(n) == len(cuts) + 1 and max(r["count"] for r in n) < 3 * 20_000 / len(n)
    exact = df.select("doc_id", ranges.bucket_of(F.col("text"), F.col("doc_id"), cuts).alias("b")).collect()
    assert all(r.b == sum(("one text", r.doc_id) >= c for c in cuts) for r in exact[::97])


def test_plan_has_no_python(spark):
    plan = exact_dedup._ordered(documents(spark), "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
