"""Operators that hand on whole rows, on tables with a column for every name they use inside."""

import pytest

from cordon.llm import exact_dedup, mixing, ngram_join
from helpers import documents, odd_documents, with_names_of

RUNS = {"exact": (exact_dedup, exact_dedup.keep_one), "ngram": (ngram_join, ngram_join.keep_one), "mix": (mixing, mixing.take_mix)}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_every_internal_name(spark, monkeypatch, name):
    module, run = RUNS[name]
    plain = documents(spark, [r for i, r in enumerate(odd_documents()) if len(r[1] or "") < 50_000])
    df = with_names_of(monkeypatch, module, run, plain)
    out = run(df)
    assert out.columns == df.columns
    rows = out.collect()
    extra = [c for c in df.columns if c not in plain.columns]
    assert rows and all(r[c] == f"own {c}" for r in rows for c in extra)
    if name != "mix":  # whose hash leaves other columns out of account: the same rows stay
        assert sorted(str((r.doc_id, r.text)) for r in rows) == sorted(str((r.doc_id, r.text)) for r in run(plain).collect())
