"""Alignment against a plain merge of two tokenizers' tokens, document by document."""

import base64
import collections
import hashlib
import random

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cordon.llm import align
from cordon.llm.token_counts import byte_tokens
from helpers import documents, odd_documents, prose, with_clashes

RANKS, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")


def brute(rows):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    with open(RANKS, "rb") as f:
        token = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    out, count = [], collections.Counter()
    for r in rows:
        text = r[1] or ""
        a = own.encode(" " + text, add_special_tokens=False).ids if text else []
        b = other.encode(text) if text else []
        a_bytes = [token[i] for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if other.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i in b for p in [other.id_to_piece(i)]]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out.append((r[0], 0, 0, [], []))
            continue
        links, groups, i, j, x, y, left, right = [], [], 0, 0, len(a_bytes[0]), len(b_bytes[0]), [a[0]], [b[0]]
        while True:
            links.append((a[i], b[j]))
            if x == y:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
                if i + 1 == len(a):
                    break
            step_a, step_b = x <= y, y <= x
            if step_a:
                i += 1
                x += len(a_bytes[i])
                left.append(a[i])
            if step_b:
                j += 1
                y += len(b_bytes[j])
                right.append(b[j])
        count.update(set(links))
        out.append((r[0], len(a), len(b), groups, links))
    most = collections.Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return sorted((str(i), n_a, n_b, len(g), len(links), ";".join(g), sum(count[p] == most[p[0]] for p in links),
                   sum(count[p] for p in links)) for i, n_a, n_b, g, links in out)


def rows_of(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in df.collect())


def _rows():
    rng = random.Random(8)
    odd = [r for r in odd_documents()]
    parts = [" ", "  ", "\n", "\t", "a", "der", "the", "ing", "'s", "12", "!?", "\u00e9", "\u6f22\u5b57", "\U0001f600", "\u2581", "<0x41>",
             "<|endoftext|>", "<s>", "\u00a0", "\x00", "\u0301", "Stra\u00dfe", "\u3000"]
    odd += [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30))), "en", "s", 0) for i in range(150)]
    return odd + [(400, " " * 300_000, None, None, None), (401, " " * 5000 + "x", None, None, None)]


@pytest.mark.parametrize("chunk", [align.CHUNK_BYTES, 700])
def test_against_a_plain_merge(spark, monkeypatch, chunk):
    monkeypatch.setattr(align, "CHUNK_BYTES", chunk)
    rows = _rows()
    want = brute(rows)
    assert any(w[1] == 0 and w[0] != "None" for w in want) and sum(w[1] > 0 for w in want) > 100
    df = with_clashes(documents(spark, rows))
    assert rows_of(align.align(df, RANKS, P.PATTERN, PIECES)) == want
    digests = sorted((str(r.doc_id), r.groups) for r in align.align(df, RANKS, P.PATTERN, PIECES, digest=True).collect())
    assert digests == sorted((w[0], hashlib.sha256(w[5].encode()).hexdigest() if w[1] else "") for w in want)


def test_empty_table(spark):
    assert align.align(documents(spark, []), RANKS, P.PATTERN, PIECES).collect() == []
    only = align.align(documents(spark, [(1, None, None, None, None), (2, "", None, None, None)]), RANKS, P.PATTERN, PIECES).collect()
    assert sorted(map(tuple, only)) == [(1, 0, 0, 0, 0, "", 0, 0), (2, 0, 0, 0, 0, "", 0, 0)]


def test_a_chunk_is_rows_of_a_document_each(spark, monkeypatch):
    """Chunks as wide rows filled an executor: the reader holds thousands of rows of a row group."""
    monkeypatch.setattr(align, "ROW_GROUP_BYTES", 1 << 14)
    rng = random.Random(3)
    rows = [(i, prose(rng, 40), None, None, None) for i in range(1500)]
    chunks = align.aligned_chunks(documents(spark, rows).coalesce(1), RANKS, P.PATTERN, PIECES)
    found = chunks.collect()
    docs, (pairs,) = [r for r in found if r.a is None], [r for r in found if r.a is not None]
    assert sorted(r.doc_id for r in docs) == list(range(1500)) and {r.chunk for r in docs} == {pairs.chunk}
    assert all(sum(r.link_n) == r.n_links > 0 and len(set(r.link_pair)) == len(r.link_pair) == len(r.link_n) for r in docs)
    held = collections.Counter(p for r in docs for p in r.link_pair)
    assert [held[p] for p in range(len(pairs.a))] == pairs.pair_docs and len(set(zip(pairs.a, pairs.b))) == len(pairs.b)
    written = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in chunks.inputFiles()]
    assert max(m.row_group(k).num_rows for m in written for k in range(m.num_row_groups)) < 500


def test_ids_equal_the_other_library():
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    ranks = byte_tokens(RANKS, P.PATTERN)
    for r in _rows():
        text = " " + (r[1] or "")
        assert ranks.encode(text) == own.encode(text, add_special_tokens=False).ids
