"""Token attribution against another library's offsets, both allocation rules, fields of records."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cordon.llm import token_counts
from helpers import documents, odd_documents, prose, rows_of, with_clashes

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def brute(text, rule):
    """Section counts from the tokens' own bytes, one token and one byte at a time."""
    text = text or ""
    raw = text.encode()
    tokens = token_counts.byte_tokens(RANKS, PATTERN)
    parts = raw.split(b"\n")
    lines = [p + b"\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] or len(parts) == 1 else [])
    owner = [i for i, line in enumerate(lines) for _ in line]
    n, over = [0] * len(lines), [0] * len(lines)
    at = 0
    for t in tokens.encode(text):
        size = len(tokens.encoding.decode_single_token_bytes(t))
        own = owner[at:at + size]
        best = own[0] if rule == "start" else max(sorted(set(own)), key=own.count)
        n[best] += 1
        over[best] += len(set(own)) > 1
        at += size
    assert at == len(raw)
    return list(zip(n, over))


def _texts():
    rng = random.Random(2)
    out = [r[1] for r in odd_documents()]
    for _ in range(60):
        out.append("".join(rng.choice(["\n", "\n\n", " ", "  \n \n", "é", "日本", prose(rng, 3), "\t\n", "\r\n", "😀"])
                           for _ in range(rng.randint(0, 25))))
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections(spark, rule):
    texts = _texts()
    df = with_clashes(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]))
    got = {}
    for r in token_counts.count_sections(df, RANKS, PATTERN, rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = (r.n_tokens, r.n_crossing)
    for i, t in enumerate(texts):
        assert [got[i][k] for k in sorted(got[i])] == brute(t, rule), repr(t)


def test_totals_equal_the_other_library(spark):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = _texts()
    df = documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    total = {r.doc_id: r.n for r in token_counts.count_sections(df, RANKS, PATTERN).groupBy("doc_id").agg({"n_tokens": "sum"})
             .withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert all(total[i] == len(own.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts))


def test_fields_of_turns(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hello there\n"), (1, 1, "assistant", None), (None, None, None, "x")],
                                  "conv_id long, turn int, role string, text string")
    rows = token_counts.count_fields(turns, ["conv_id", "turn"], ["role", "text"], RANKS, PATTERN).collect()
    tokens = token_counts.byte_tokens(RANKS, PATTERN)
    assert len(rows) == 6
    whole = len(tokens.encoding.encode_ordinary("user\nhello there\n\n"))
    assert sum(r.n_tokens for r in rows if (r.conv_id, r.turn) == (1, 0)) == whole
    assert {r.field for r in rows} == {"role", "text"}


def test_wrong_rule_and_empty_table(spark):
    with pytest.raises(ValueError):
        token_counts.attribute(np.array([1]), np.array([0, 1]), "half")
    assert rows_of(token_counts.count_sections(documents(spark, []), RANKS, PATTERN)) == []


def test_runs_of_white_space_of_any_length(monkeypatch):
    """Cut before the pattern sees them, runs give the tokens that the pattern would."""
    tokens, own = token_counts.byte_tokens(RANKS, PATTERN), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    rng = random.Random(6)
    short = token_counts.re.compile(token_counts._LONG_SPACE.pattern.replace("1024", "2"))
    parts = [" ", "  ", "\n", "\t", "a", "'s", "12", "!", "é", "\u3000", "\x1c", "\x85", "漢", "    ", "don't"]
    monkeypatch.setattr(token_counts, "_LONG_SPACE", short)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert tokens.encode(text) == tokens.encoding.encode_ordinary(text) == own.encode(text, add_special_tokens=False).ids, repr(text)
    monkeypatch.undo()
    for text in (" " * 10_000_000, "a " + " " * 1_000_000 + "b", "\n" * 1_000_000 + "x", "!" * 1_000_000, "x" * 1_000_000):
        ids = tokens.encode(text)
        assert tokens.encoding.decode(ids) == text
        if len(text) < 2_000_000:
            assert ids == own.encode(text, add_special_tokens=False).ids
