"""Best-fit packing: plan, tokens against the tokenizer, pieces that tile sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cordon.llm import packing, tokens
from helpers import documents, odd_documents, prose, rows_of, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")


def _fill(runs):
    out, used = defaultdict(list), defaultdict(set)
    for length, a, b, first, each, offset in runs:
        for rank in range(a, b + 1):
            assert rank not in used[length]
            used[length].add(rank)
            out[first + (rank - a) // each].append((offset + (rank - a) % each * length, length))
    return out, {k: len(v) for k, v in used.items()}


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_piece_once_without_gaps(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 64, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, rng.choice([1, 5, 300])) for _ in range(rng.randint(0, 60))}
    filled, used = _fill(packing.plan_runs(counts, capacity))
    assert used == counts
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_plan_uses_exact_complements():
    # 10 = 6 + 4 = 5 + 3 + 2 = 7 + 1 + 1 + 1
    for counts in ({6: 4, 4: 4}, {5: 2, 3: 2, 2: 2}, {7: 3, 1: 9}, {10: 5}, {5: 6}):
        filled, _ = _fill(packing.plan_runs(counts, 10))
        assert len(filled) * 10 == sum(k * n for k, n in counts.items())


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.lognormal(6, 1, 20_000).astype(int), 1, 2048)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    filled, _ = _fill(packing.plan_runs(counts))
    assert len(filled) <= 1.002 * -(-int(lengths.sum()) // 2048)


def test_word_ids_equal_the_tokenizer(monkeypatch):
    import pyarrow as pa

    rng = random.Random(1)
    texts = [r[1] for r in odd_documents()] + [
        "it's 'S don't <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "é ́x", "a b c", "\x01 a\x01b \x01",
        "日本語 12345 ½ ² ª", "İstanbul ΣΑΣ ǅ", "😀 👩‍👩", "\x00 x\x00", "Word, WORD! (word) wörd. 'tis ÀÉ×÷",
        prose(rng, 3000)]
    own = Tokenizer.from_file(PATH)
    for limit in (tokens.DEFAULT_MAX_WORDS, 50):  # also while words are forgotten
        for row, ids in tokens.encoded_texts(pa.array(texts), PATH, limit):
            assert ids.tolist() == own.encode(texts[row] or "", add_special_tokens=False).ids, texts[row][:50]


def test_packed_rows(spark):
    docs = with_clashes(documents(spark))
    rows = packing.packed_digests(docs, PATH).collect()
    own = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, *_ in odd_documents():
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want.append((doc_id, k, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for v in places.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 2048


def test_packed_pieces_hold_the_ids(spark):
    rows = packing.packed_pieces(documents(spark, [(1, "a few words", "en", "s", 1), (2, None, None, None, None)]), PATH, 4).collect()
    own = Tokenizer.from_file(PATH).encode("a few words", add_special_tokens=False).ids + [0]
    got = sorted((r.piece, np.frombuffer(r.ids, "<u4").tolist()) for r in rows if r.doc_id == 1)
    assert sum((ids for _, ids in got), []) == own
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows if r.doc_id == 2] == [[0]]


def test_empty_table(spark):
    assert rows_of(packing.packed_digests(documents(spark, []), PATH)) == []


@pytest.mark.parametrize("max_words", [20, 60, 400])
def test_full_word_table_keeps_words_met_again(max_words):
    """Common words outlive rare ones, the table stays within its bound, and the ids are the tokenizer's."""
    import pyarrow as pa

    rng = random.Random(max_words)
    texts = ["the same few words, again " + prose(rng, 9) for _ in range(300)]
    tokenizer = Tokenizer.from_file(PATH)
    encoder = tokens.WordIds(PATH, max_words)
    for i in range(0, len(texts), 2):
        for t in tokens.slices(pa.array(texts[i:i + 2])):
            ids, bounds = encoder.encode(t)
            assert len(encoder.keys) <= max(max_words, 30)
            for k in range(t.n):
                want = tokenizer.encode(texts[i + k], add_special_tokens=False).ids
                assert ids[bounds[k]:bounds[k + 1]].tolist() == want
    assert len(encoder.parts) + len(encoder.old_parts) <= 6 * max(max_words, 30)
