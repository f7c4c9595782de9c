"""Personal data: base spans against Python's regular expressions, labelers, statistics, looser forms."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from cordon.llm import pii
from helpers import documents, odd_documents, prose, rows_of, with_clashes

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def holds(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in hit.split(".")),
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        if not {"email": "@", "ip": ".", "phone": "+"}.get(kind, "") in (text or ""):
            continue  # these patterns take Python quadratic time on long runs
        out += [(m.start(), k, m.end()) for m in re.finditer(p, text or "") if holds(kind, m.group())]
    return sorted(out)


def check(spark, texts):
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    for r in pii.span_digests(with_clashes(documents(spark, rows))).collect():
        want = base(texts[r.doc_id])
        written = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)], texts[r.doc_id][:80]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest(), texts[r.doc_id][:80]
        assert set(written) <= set(r.spans.split(",")) | {""}


HARD = ["a@b.c..d@e.f", "a@b.c+d@e.f g@h", "@b.c x@-.- é.a@b.c", "1.2.3.4.5.6.7.8 01.002.255.256 1.2.3", "4111 1111-1111 1111 and 4111111111111112",
        "+1 (415) 555-2671, +12 +1() 5 +49.30.1234567 ++33 1 23 45 67 89", "1.1.1.1@x.y +1-2-3@4.5", "😀a@b.c😀 1.2.3.4 é+1 415 555 2671",
        "4111111111111111 4111111111111111", "4111 1111 1111 1111 4111 1111 1111 1111", "", None, "\n4111-1111-1111-1111\n",
        "00000000000000 0000 0000 0000 0000", "999999999999999999999.1.1.1"]


def test_hard_cases(spark):
    check(spark, HARD + [r[1] for r in odd_documents()])


@pytest.mark.parametrize("seed", range(2))
def test_random_strings(spark, seed):
    rng = random.Random(seed)
    check(spark, ["".join(rng.choice("aB1234567890 .-+()@@é%\n") for _ in range(rng.randint(0, 300))) for _ in range(300)])


def test_long_runs_take_linear_time(spark):
    """Python's own expressions take quadratic time here, so the expected spans are written out."""
    cases = [("a" * 300_000, ""), ("1" * 300_000, ""), ("a." * 100_000 + "@", ""), ("1." * 7_999 + "1", None),
             ("a@" + "b." * 100_000 + "c", "email:0:200003"), ("+1" + "(" * 300_000, ""), ("1-" * 100_000, ""),
             ("a@b.c " * 300, ",".join(f"email:{6 * i}:{6 * i + 5}" for i in range(300)))]
    rows = [(i, t, None, None, None) for i, (t, _) in enumerate(cases)]
    for r in pii.span_digests(documents(spark, rows)).collect():
        want = cases[r.doc_id][1]
        if want is None:
            assert r.n_ip == 2_000
        else:
            assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and r.spans == want


def test_reliabilities_find_the_bad_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.6
    rates = np.array([0.95, 0.9, 0.85, 0.6])
    votes = np.where((rng.random((20_000, 4)) < rates) == truth[:, None], 1.0, -1.0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    p, right = pii.reliabilities(patterns, counts.astype(float))
    assert np.abs(right - rates).max() < 0.03
    w = pii.regression(patterns, p, counts.astype(float))
    q = 1 / (1 + np.exp(-(w[0] + votes @ w[1:])))
    assert ((q > 0.5) == truth).mean() > 0.95


def test_looser_forms_need_support(spark):
    rng = random.Random(3)
    texts = [prose(rng, 30) + f" Phone: +1 (415) 555-{1000 + i} and mail ab{i}@mail.example.com card 4111111111111111 " for i in range(300)]
    texts += [f"please call ({rng.randint(200, 999)}) 555-{2000 + i} today" for i in range(30)]
    texts += [f"write to someone{i} [at] example.com now" for i in range(5)]
    texts += [f"order no 4111 1111 1111 {1000 + i} shipped" for i in range(50)]  # most fail the checksum
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r.spans for r in pii.span_digests(documents(spark, rows)).collect()}
    assert all(got[i].count(":") == 6 for i in range(300))
    assert all(":" in got[i] for i in range(300, 330)), got[300]
    wrong = [i for i in range(335, 385) if not base(texts[i])]
    assert len(wrong) > 30 and all(got[i] == "" for i in wrong)


LOOSE = [
    ("mail to jane.roe (at) example (dot) org please", "email", "jane.roe (at) example (dot) org"),
    ("contact jane at example dot com today", "email", "jane at example dot com"),
    ("correo: jane[arroba]example.es", "email", "jane[arroba]example.es"),
    ("card 4222 2222 2222 2 expires", "card", "4222 2222 2222 2"),
    ("visa 4111.1111.1111.1111 ok", "card", "4111.1111.1111.1111"),
    ("Telefon 030/123 4567 abends", "phone", "030/123 4567"),
    ("Tél. 01 23 45 67 89 merci", "phone", "01 23 45 67 89"),
    ("teléfono 612 345 678 gracias", "phone", "612 345 678"),
    ("please call (415) 555-2671 today", "phone", "(415) 555-2671"),
]
NOT_LOOSE = ["we met at noon dot by dot", "order no 4222 2222 2222 3 shipped", "id 4111.1111.1111.1112", "version 10.20.30",
             "in 1999 2000 2001", "page 612 345 678901", "look at example", "ISBN 3 16 148410 0", "0.123 4567"]


def test_looser_forms_of_each_kind(spark):
    rng = random.Random(5)
    texts = [t for t, _, _ in LOOSE] + NOT_LOOSE
    n = len(texts)
    texts += [prose(rng, 30) + f" Tel: +1 (415) 555-{1000 + i}, mail ab{i}@mail.example.com, card 4111111111111111 " for i in range(200)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in pii.span_digests(documents(spark, rows)).collect()}
    for i, (text, kind, hit) in enumerate(LOOSE):
        at = text.index(hit)
        assert got[i].spans == f"{kind}:{at}:{at + len(hit)}", text
        assert got[i].n_email + got[i].n_ip + got[i].n_card + got[i].n_phone == 0
    assert [texts[i] for i in range(len(LOOSE), n) if got[i].spans] == []


def test_many_spans_and_long_runs_take_linear_time(spark):
    """Tens of thousands of spans in a text, and runs that start every looser form and finish none."""
    cases = ["a@b.c " * 40_000, "1.2.3.4 300.1.1.1 " * 20_000, "a at b dot " * 10_000, "4 " * 100_000, "[at]" * 50_000,
             "0" * 300_000, "a" * 200_000 + " at ", "01 23 45 " * 10_000, "a@b.c 0123 45678 " * 10_000]
    rows = [(i, t, None, None, None) for i, t in enumerate(cases)]
    began = time.monotonic()
    got = {r.doc_id: r for r in pii.span_digests(documents(spark, rows)).collect()}
    assert time.monotonic() - began < 90
    for i, kind, each, length in ((0, "email", 6, 5), (1, "ip", 18, 7)):
        written = ",".join(f"{kind}:{at}:{at + length}" for at in range(0, len(cases[i]), each))
        assert got[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest()
    assert got[8].n_email == 10_000 and got[5].spans == got[4].spans == ""


def test_overlaps_of_many_spans_against_all_pairs(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a@b.c", "1.2.3.4", "999.1.1.1", "0123 45678", "4111 1111 1111 1112", "+1 415 555 2671", "x"])
                      for _ in range(900)) for _ in range(3)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    for r in pii.candidates(documents(spark, rows)).collect():
        spans = [(s.start, s.kind, s.end) for s in r.spans if s.base]
        assert spans == base(texts[r.doc_id])
        assert r.spans == sorted(r.spans) and len(r.spans) > len(spans) > 256
        assert not [s for s in r.spans if not s.base and any(a < s.end and s.start < b for a, _, b in spans)]


def test_plan_has_no_python(spark):
    plan = pii.candidates(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert rows_of(pii.span_digests(documents(spark, []))) == []
