"""Token ids of whole texts, by a public tokenizer file whose path is a parameter.

The tokenizers meant here split at white space before anything else and mark the ends of words, so
the ids of a text are the ids of its space-separated words in order. Words repeat, so each worker
keeps a bounded table of the words it has met (by 64-bit hash) and asks the tokenizer only for new
ones, many at a time.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from cordon.llm.words import Texts, slices

# A character that is no white space, letter or number: among spaces it is a word of its own.
SEPARATOR = "\x01"
# Latin letters that are composed and have one lower-case form, then marks: pre-tokens of their own.
LETTERS_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:&*%$#)\]}]*)").fullmatch
WORDS_PER_CALL = 64
DEFAULT_MAX_WORDS = 200_000


class WordIds:
    """Ids of words under one tokenizer file, at most ``max_words`` of them: when there are more, the words
    not met again since they were learned, or since the last time, are forgotten; if over half were, all are.

    A new word made of letters and then marks is looked up as those two parts, since the tokenizer
    separates letters from marks. Parts are met more often than whole words.
    """

    def __init__(self, path: str, max_words: int = DEFAULT_MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For lower-case Latin letters normalizing changes nothing and the pre-tokens are the words.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.max_words = max_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        ids = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        if len(ids) != 1 or not self.ends_word.any():
            raise ValueError("the tokenizer has no single id for the separator, or no ends of words")
        self.separator = ids[0]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # hashes of words, sorted
        self.begin = np.zeros(0, np.int64)  # of a word's ids in store
        self.length = np.zeros(0, np.int64)
        self.store = np.zeros(0, np.uint32)
        self.again = np.zeros(0, bool)  # met after it was learned
        self.parts: dict[str, bytes] = {}  # ids as unsigned 32-bit integers
        self.old_parts: dict[str, bytes] = {}

    def _forget(self, new: int) -> None:
        keep = np.flatnonzero(self.again)
        if len(keep) > self.max_words // 2 or len(keep) + new > self.max_words:
            return self._clear()
        length = self.length[keep]
        done = np.cumsum(length)
        total = int(done[-1]) if len(done) else 0
        self.store = self.store[np.repeat(self.begin[keep] - (done - length), length) + np.arange(total)]
        self.keys, self.begin, self.length = self.keys[keep], done - length, length
        self.again = np.zeros(len(keep), bool)
        self.old_parts, self.parts = self.parts, {}

    def _has_part(self, part: str) -> bool:
        if part not in self.parts:
            if part not in self.old_parts:
                return False
            self.parts[part] = self.old_parts.pop(part)
        return True

    def _learn_parts(self, words: list[str], letters: bool) -> None:
        """Encode words many at a time; in between stands the separator, or nothing if each word is one
        run of lower-case Latin letters, as then its last token says so."""
        tokenizer = self.letters if letters else self.tokenizer
        groups = [words[i:i + WORDS_PER_CALL] for i in range(0, len(words), WORDS_PER_CALL)]
        joint = " " if letters else f" {SEPARATOR} "
        alone = []
        for group, e in zip(groups, tokenizer.encode_batch_fast([joint.join(g) for g in groups], add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype=np.uint32)
            if letters:
                after = np.flatnonzero(self.ends_word[ids]) + 1
                before = after
            else:
                before = np.append(np.flatnonzero(ids == self.separator), len(ids))
                after = before + 1
            if len(before) != len(group):
                alone += group
                continue
            raw, at = ids.tobytes(), 0
            for word, b, a in zip(group, before.tolist(), after.tolist()):
                self.parts[word] = raw[4 * at:4 * b]
                at = a
        for word in alone:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            self.parts[word] = np.asarray(ids, dtype=np.uint32).tobytes()

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        split = []
        letters, others, alone = set(), set(), set()
        for word in words:
            found = LETTERS_AND_MARKS(word)
            if found:
                stem, tail = found.groups()
                stem = stem.lower()
                if not self._has_part(stem):
                    letters.add(stem)
                if tail and not self._has_part(tail):
                    others.add(tail)
            else:
                stem, tail = word, ""
                if not self._has_part(stem):
                    (alone if SEPARATOR in stem else others).add(stem)
            split.append((stem, tail))
        self._learn_parts(sorted(letters), True)
        self._learn_parts(sorted(others), False)
        for word in alone:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            self.parts[word] = np.asarray(ids, dtype=np.uint32).tobytes()
        parts = self.parts
        parts[""] = b""
        raw = [parts[stem] + parts[tail] if tail else parts[stem] for stem, tail in split]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        begin = len(self.store) + np.cumsum(lengths) - lengths
        self.store = np.concatenate([self.store, np.frombuffer(b"".join(raw), dtype=np.uint32)])
        by = np.argsort(hashes)
        keys = np.concatenate([self.keys, hashes[by]])
        order = np.argsort(keys, kind="stable")  # merges two sorted runs
        self.keys = keys[order]
        self.begin = np.concatenate([self.begin, begin[by]])[order]
        self.length = np.concatenate([self.length, lengths[by]])[order]
        self.again = np.concatenate([self.again, np.zeros(len(by), bool)])[order]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice one after another, and where each text's ids begin (n + 1)."""
        codes, hashes = pd.factorize(texts.hashes())
        hashes = np.asarray(hashes, dtype=np.uint64)
        if len(hashes):
            first = np.full(len(hashes), -1, dtype=np.int64)
            rows = np.arange(len(codes) - 1, -1, -1)
            first[codes[rows]] = rows

            def unknown() -> np.ndarray:
                at = np.searchsorted(self.keys, hashes)
                known = at < len(self.keys)
                known[known] = self.keys[at[known]] == hashes[known]
                self.again[at[known]] = True
                return np.flatnonzero(~known)

            new = unknown()
            if len(new) and len(self.keys) + len(new) > self.max_words:
                self._forget(len(new))
                new = unknown()
            if len(new):
                raw = texts.data.tobytes()
                spans = first[new]
                words = [raw[a:b].decode("utf-8", "replace")
                         for a, b in zip(texts.starts[spans].tolist(), texts.ends[spans].tolist())]
                self._learn(hashes[new], words)
            slot = np.searchsorted(self.keys, hashes)[codes]
            begin, length = self.begin[slot], self.length[slot]
        else:
            begin = length = np.zeros(0, np.int64)
        done = np.cumsum(length)
        total = int(done[-1]) if len(done) else 0
        ids = self.store[np.repeat(begin - (done - length), length) + np.arange(total)]
        at = texts.word_offsets()
        bounds = np.concatenate(([0], done))[at]
        return ids, bounds


_loaded: dict[tuple, WordIds] = {}


def word_ids(path: str, max_words: int = DEFAULT_MAX_WORDS) -> WordIds:
    """The worker's table for a tokenizer file; kept between tasks of the same worker."""
    key = (path, max_words)
    if key not in _loaded:
        _loaded[key] = WordIds(path, max_words)
    return _loaded[key]


def encoded_texts(column: pa.Array, path: str, max_words: int = DEFAULT_MAX_WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) for every text of a string column, in order; null counts as empty."""
    encoder = word_ids(path, max_words)
    for texts in slices(column):
        ids, bounds = encoder.encode(texts)
        for i in range(texts.n):
            yield texts.first + i, ids[bounds[i]:bounds[i + 1]]
