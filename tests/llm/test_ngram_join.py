"""N-gram Jaccard join against all pairs in plain Python; hot groups, blocks, chains."""

import random
from collections import Counter

import numpy as np
import pytest

from cordon.llm import components as comp, ngram_join
from helpers import documents, odd_documents, prose, rows_of, with_clashes, words


def grams(text):
    w = words(text)
    return tuple(w), frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    texts = {}
    for r in rows:
        w, s = grams(r[1])
        if w:
            texts[w] = s
    keys = list(texts)
    label = {k: k for k in keys}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    links = Counter()
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(texts[a] & texts[b])
            if 5 * both >= 4 * (len(texts[a]) + len(texts[b]) - both):
                links[a] += 1
                links[b] += 1
                label[find(a)] = find(b)
    order = lambda i: (i is None, i or 0)
    rep, cls, n = {}, {}, Counter()
    for r in rows:
        w = grams(r[1])[0]
        if w:
            n[w] += 1
            rep[w] = min(rep.get(w, r[0]), r[0], key=order)
            cls[find(w)] = min(cls.get(find(w), r[0]), r[0], key=order)
    out = []
    for r in rows:
        w = grams(r[1])[0]
        out.append((r[0], cls[find(w)], links[w], rep[w], n[w]) if w else (r[0], r[0], 0, r[0], 1))
    return out


def near_rows(seed=3, group=40):
    rng = random.Random(seed)
    base = prose(rng, 150).split()
    rows = []
    for i in range(group):  # one group of near copies, many of them linked
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        rows.append((i, " ".join(w), None, None, None))
    chain = prose(rng, 100).split()
    for i in range(12):  # neighbours are linked, the ends are not
        w = list(chain)
        w[:i] = prose(random.Random(99), 12).split()[:i]
        rows.append((200 + i, " ".join(w), None, None, None))
    rows += [(300 + i, prose(rng, rng.randint(1, 60)), None, None, None) for i in range(60)]
    rows += [(400 + i, rows[0][1], None, None, None) for i in range(30)]
    return rows


def check(spark, rows):
    got = ngram_join.similar_documents(with_clashes(documents(spark, rows))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_odd_documents(spark):
    check(spark, odd_documents())


def test_groups_and_chains(spark):
    check(spark, near_rows())


def test_components_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_NGRAMS", 700)
    check(spark, near_rows(8))


def test_shape_meets_the_target_recall():
    bands, rows = ngram_join.bands_and_rows()
    assert bands * rows <= ngram_join.MAX_HASHES
    assert 1 - (1 - 0.8 ** rows) ** bands >= ngram_join.TARGET_RECALL
    with pytest.raises(ValueError):
        ngram_join.bands_and_rows(0.8, 1.0, 4)


def test_band_recall_at_the_threshold(spark):
    """Pairs at about the threshold share a band nearly always, distant ones nearly never."""
    rng = random.Random(1)
    rows, kinds = [], []
    for i in range(300):
        a = prose(rng, 200).split()
        b = list(a)
        for k in range(4 if i % 2 else 30):
            b[rng.randrange(len(b))] = prose(rng, 1)
        sa, sb = grams(" ".join(a))[1], grams(" ".join(b))[1]
        kinds.append(len(sa & sb) / len(sa | sb))
        rows += [(2 * i, " ".join(a), None, None, None), (2 * i + 1, " ".join(b), None, None, None)]
    bands = {r.doc_id: set(r.bands) for r in ngram_join.signatures(documents(spark, rows)).collect()}
    hit = [bool(bands[2 * i] & bands[2 * i + 1]) for i in range(300)]
    high = [h for h, j in zip(hit, kinds) if j >= 0.8]
    low = [h for h, j in zip(hit, kinds) if j <= 0.4]
    assert len(high) > 100 and np.mean(high) == 1.0
    assert len(low) > 100 and np.mean(low) < 0.1


def test_keep_one(spark):
    rows = near_rows() + [near_rows()[0]] * 3
    df = with_clashes(documents(spark, rows))
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({b[1] for b in brute(rows)})
    odd = documents(spark)
    kept = ngram_join.keep_one(odd).collect()
    texts = [words(r.text) for r in kept]
    assert sum(not t for t in texts) == 3  # texts without words are classes of their own
    assert len({tuple(t) for t in texts if t}) == len([t for t in texts if t])


def test_empty_table(spark):
    assert rows_of(ngram_join.similar_documents(documents(spark, []))) == []
    assert rows_of(ngram_join.keep_one(documents(spark, []))) == []


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(i, i + 1) for i in range(100, 103)] + [(5, 5), (200, 200)]
    got = {r.node: r.label for r in comp.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(71)}, **{i: 100 for i in range(100, 104)}}


def test_texts_that_share_an_id_are_fetched_once(spark, monkeypatch):
    fetched = spark.sparkContext.accumulator(0)
    sets = ngram_join._ngram_sets

    def counted(n):
        inner = sets(n)

        def run(batches):
            def tap():
                for batch in batches:
                    fetched.add(batch.num_rows)
                    yield batch
            return inner(tap())
        return run

    monkeypatch.setattr(ngram_join, "_ngram_sets", counted)
    rows = [(None if i % 2 else 7, *r[1:]) for i, r in enumerate(near_rows()[:40])]
    check(spark, rows)
    assert 0 < fetched.value <= len(rows)


def test_recall_of_a_thousand_links(spark):
    """Planted copies from 0.75 to 0.95 similarity: nearly all links that brute force finds are found."""
    rng = random.Random(12)
    rows = []
    for g in range(200):
        base = prose(rng, 120).split()
        for c in range(5):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            rows.append((10 * g + c, " ".join(w), None, None, None))
    want = {r[0]: r[2] for r in brute(rows)}
    got = {r.doc_id: r.n_links for r in ngram_join.similar_documents(documents(spark, rows)).collect()}
    assert sum(want.values()) >= 2000  # each link counts at both ends
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.99 * sum(want.values())


def test_a_slim_graph_has_the_same_components(spark):
    rng = random.Random(5)
    spokes = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(70)] + [(100, h) for h in range(200, 240)] * 2
    frame = spark.createDataFrame(spokes, "text_key long, hub long")
    slim = ngram_join._slim(frame)
    whole = comp.components(frame.selectExpr("text_key AS a", "hub AS b"))
    assert sorted(map(tuple, comp.components(slim).collect())) == sorted(map(tuple, whole.collect()))
    assert slim.count() <= len(set(spokes))
