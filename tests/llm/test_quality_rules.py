"""Quality rules: counts and verdicts against plain Python, any order gives the same verdict."""

import random

import pyarrow as pa
import pytest

from cordon.llm import rules
from cordon.llm.words import slices
from helpers import documents, odd_documents, prose, rows_of, with_clashes, words


def brute(text):
    text = text or ""
    ws = words(text)
    n = len(ws)
    seen, dup = set(), 0
    lines = 0
    for line in text.split("\n"):
        if words(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(n - 2):
        grams.setdefault(tuple(ws[i:i + 3]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    chars = sum(map(len, ws))
    base = n < 50 or 100 * len(covered) > 50 * n
    with_letter = sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in w) for w in ws)
    loud = sum(sum("A" <= c <= "Z" for c in w) >= 2 and not any("a" <= c <= "z" for c in w) for w in ws)
    bad = (base or 5 * symbols > n or 2 * dup > lines or 5 * with_letter < 4 * n or 10 * loud > 3 * n
           or chars < 2 * n or chars > 20 * n)
    return n, chars, symbols, dup, len(covered), base, not bad


def _texts():
    rng = random.Random(11)
    out = [r[1] for r in odd_documents()]
    for _ in range(60):
        t = prose(rng, rng.randint(0, 150)).split(" ")
        for _ in range(rng.randint(0, 30)):
            if t:
                i = rng.randrange(len(t))
                t[i] = rng.choice(["A", "AB", "***", "|", "é", "a", "a", "12", t[0], "x\n", "\n"])
        out.append(rng.choice([" ", "\n", "  "]).join(t) if rng.random() < 0.4 else " ".join(t))
    return out


def test_judge_against_brute_force(spark):
    texts = _texts()
    df = with_clashes(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    for r in rules.judge(df).collect():
        assert tuple(r)[1:8] == brute(texts[r.doc_id]), texts[r.doc_id]
        assert (r.failed_rule is None) == (r.kept or r.base_failed and r.failed_rule is None)


@pytest.mark.parametrize("seed", range(8))
def test_order_does_not_change_verdicts(seed):
    order = list(rules.RULES)
    random.Random(seed).shuffle(order)
    texts = _texts()
    for t in slices(pa.array(texts)):
        verdict = rules.cascade(t, order)
        for i in range(t.n):
            assert (verdict[i] < 0) == brute(texts[t.first + i])[6]


def test_rule_order_has_every_rule(spark):
    assert sorted(rules.rule_order(documents(spark))) == sorted(rules.RULES)
    assert sorted(rules.rule_order(documents(spark, []))) == sorted(rules.RULES)


def test_keep_good_keeps_columns_and_rows(spark):
    df = with_clashes(documents(spark))
    kept = rules.keep_good(df)
    assert kept.columns == df.columns
    want = [r for r in df.collect() if brute(r.text)[6]]
    assert rows_of(kept) == sorted(map(tuple, want), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rules.keep_good(documents(spark, [])).count() == 0
    assert rules.judge(documents(spark, [])).count() == 0
