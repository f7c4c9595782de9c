"""Source mixing: targets, thresholds against a sorted version, hot sources, repeated ids."""

import random
from collections import defaultdict
from hashlib import md5

import pytest

from cordon.llm import mixing
from helpers import documents, odd_documents, rows_of, with_clashes, words


def brute_targets(sizes):
    total, fixed = float(sum(sizes)), {}
    w = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        share = {i: rest * w[i] / sum(w[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 3 * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        for i in over:
            fixed[i] = 3.0 * sizes[i]


@pytest.mark.parametrize("seed", range(20))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, rng.randint(1, 10 ** 6)]) for _ in range(rng.randint(1, 12))]
    got = mixing.targets([(str(i), n) for i, n in enumerate(sizes)])
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * n for t, n in zip(got, sizes))


def brute(rows):
    by = defaultdict(list)
    for i, (doc_id, text, _, source, _) in enumerate(rows):
        h = int(md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)
        by[source].append((h, len(words(text)), i))
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(n for _, n, _ in by[s]) for s in order]
    out = {}
    for s, size, target in zip(order, sizes, brute_targets(sizes)):
        epochs = min(3, int(target // size)) if size else 0
        left, at = target - epochs * size, 0
        groups = defaultdict(list)
        for h, n, i in by[s]:
            groups[h].append((n, i))
        for h in sorted(groups):
            own = sum(n for n, _ in groups[h])
            more = epochs < 3 and (at + own <= left or (at <= left and left - at >= own / 2))
            for n, i in groups[h]:
                out[i] = (n, size, target, n * (epochs + more))
            at += own
    return out


def test_rows_against_a_sorted_version(spark):
    rng = random.Random(4)
    rows = odd_documents() + [(1000 + i, " ".join("w" for _ in range(rng.randint(0, 40))), "en",
                               rng.choice(["hot"] * 6 + ["a", "b", "é", None, "z"]), 1) for i in range(500)]
    want = brute(rows)
    got = mixing.mix_rows(with_clashes(documents(spark, rows))).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=str) == \
        sorted(((rows[i][0], n, s, round(t, 6), k) for i, (n, s, t, k) in want.items()), key=str)
    per = defaultdict(lambda: [0, 0.0, 0])
    for r in got:
        per[r.source][0] += r.taken
        per[r.source][1] = r.target
        assert r.taken <= 3 * r.size
    for taken, target, _ in per.values():
        assert abs(taken - target) <= 40_000 / 2 + 1


def test_thresholds_are_nested():
    # a larger budget takes every document that a smaller one takes
    rows = [(i, "w " * (i % 17), None, "s", 1) for i in range(300)]
    hashes = {i: int(md5(str(i).encode()).hexdigest()[:15], 16) for i, *_ in rows}
    taken = []
    for budget in (100, 500, 900):
        at, mine = 0, set()
        for i in sorted(hashes, key=hashes.get):
            if at + i % 17 > budget:
                break
            at += i % 17
            mine.add(i)
        taken.append(mine)
    assert taken[0] <= taken[1] <= taken[2]


def test_take_mix_repeats_whole_rows(spark):
    rows = odd_documents() + [(500 + i, "some more words here", "en", "s1", 1) for i in range(50)]
    df = with_clashes(documents(spark, rows))
    plan = {(r.doc_id, r.source): r.copies for r in mixing.mix_rows(df).collect()}
    taken = mixing.take_mix(df)
    assert taken.columns == df.columns
    want = [tuple(r) for r in df.collect() for _ in range(plan[r.doc_id, r.source])]
    assert rows_of(taken) == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_empty_table(spark):
    assert rows_of(mixing.mix_rows(documents(spark, []))) == []
    assert rows_of(mixing.take_mix(documents(spark, []))) == []
    blank = documents(spark, [(1, "", None, "a", 0), (2, None, None, None, 0)])
    assert [r.taken for r in mixing.mix_rows(blank).collect()] == [0, 0]
