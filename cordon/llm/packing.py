"""Best-fit packing by exact complements.

Documents are tokenized once (``token_pieces``): a document's ids and one end id, cut into pieces of
at most the capacity only where it is longer than that. Which pieces share a sequence depends only on
their lengths, so the plan is made from the histogram of lengths, which has at most ``capacity`` rows
however many documents there are:

1. Exact complements. For every length, longest first, the gap it leaves is looked up among the
   single lengths, the sums of two and the sums of three lengths that are still available. A
   combination that fills the gap exactly is used as often as the availability counts allow.
2. Best fit. What is left is placed, longest first, into the open sequence with the smallest gap
   that holds it; a new sequence opens only if there is none.

The plan is a list of runs: the pieces of one length with ranks a..b go to consecutive sequences at
one offset. Pieces get their rank within their length from salted windows (``SALTS`` parts of each
length, the parts' counts summed up), so a length that a third of all pieces have is spread over many
tasks; they then meet the run that holds their rank in a broadcast join. The runs number a few
thousand at most: each uses up a length or an open group of sequences.

Edge cases: null text is empty (one piece that holds the end id alone); repeated rows and null ids
are packed like any other; an empty table gives no rows; other columns are ignored by
``token_pieces`` and carried along by ``pack``, whose added columns replace columns of those names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cordon.llm.shared import cut
from cordon.llm.tokens import encoded_texts

CAPACITY = 2048
END_ID = 0
SALTS = 512
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"
RUN_SCHEMA = ("run_length long, first_rank long, last_rank long, first_sequence long, per_sequence long, "
              "run_offset long")


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 text_col: str = "text") -> DataFrame:
    """Pieces of every document: ``ids`` holds the ids as little-endian unsigned 32-bit integers."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0)
            rows, nth, start, length, ids = [], [], [], [], []
            size = 0

            def flush():
                return pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(rows, pa.int64())), pa.array(nth, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

            for row, own in encoded_texts(batch.column(1), tokenizer_path):
                whole = np.append(own, np.uint32(end_id)).astype("<u4")
                raw = whole.tobytes()
                for k, at in enumerate(range(0, len(whole), capacity)):
                    rows.append(row)
                    nth.append(k)
                    start.append(at)
                    length.append(min(capacity, len(whole) - at))
                    ids.append(raw[4 * at:4 * (at + capacity)])
                size += len(raw)
                if size > 4 << 20:
                    yield flush()
                    rows, nth, start, length, ids = [], [], [], [], []
                    size = 0
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(pieces, PIECE_SCHEMA)


class _Available:
    """Availability counts by length, and how many pairs of available lengths have each sum."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.counts[length] = n
        self.there = self.counts > 0
        self.pairs = np.zeros(2 * capacity + 1, dtype=np.int64)
        for x in np.flatnonzero(self.there):
            others = np.flatnonzero(self.there[: x + 1])
            self.pairs[x + others] += 1

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if self.counts[length] == 0:
            others = np.flatnonzero(self.there)
            self.pairs[length + others] -= 1
            self.there[length] = False

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often all these lengths can be taken together."""
        return min(int(self.counts[x]) // lengths.count(x) for x in set(lengths))

    def _pairs_of(self, total: int) -> np.ndarray:
        low = np.arange(max(1, total - self.capacity), total // 2 + 1)
        return low[self.there[low] & self.there[total - low]] if len(low) else low

    def _best_pair(self, total: int, beside: tuple[int, ...]) -> tuple[int, ...] | None:
        low = self._pairs_of(total)
        # the pair that can be used most often first: fewer, longer runs
        for x in low[np.argsort(-np.minimum(self.counts[low], self.counts[total - low]), kind="stable")]:
            found = (*beside, total - int(x), int(x))
            if self.times(found):
                return found
        return None

    def filling(self, length: int) -> tuple[int, ...] | None:
        """Lengths that fill a sequence exactly together with ``length``: alone, or one, two or three more."""
        gap = self.capacity - length
        if gap == 0:
            return (length,)
        if self.there[gap] and self.times((length, gap)):
            return (length, gap)
        if self.pairs[gap] and (found := self._best_pair(gap, (length,))):
            return found
        third = np.flatnonzero(self.there[: gap - 1])[::-1]
        for x in third[self.pairs[gap - third] > 0]:
            if found := self._best_pair(gap - int(x), (length, int(x))):
                return found
        return None


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, last rank, first sequence, pieces a sequence, offset) for a histogram."""
    have = _Available(counts, capacity)
    ranks = dict.fromkeys(counts, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def put(length: int, first: int, n: int, each: int, offset: int) -> None:
        runs.append((length, ranks[length], ranks[length] + n * each - 1, first, each, offset))
        ranks[length] += n * each
        have.take(length, n * each)

    for length in sorted(counts, reverse=True):
        while have.counts[length] and (found := have.filling(length)):
            n, offset = have.times(found), 0
            for x in sorted(set(found), reverse=True):
                put(x, sequences, n, found.count(x), offset)
                offset += x * found.count(x)
            sequences += n

    gaps: list[int] = []  # sorted gaps of open groups of sequences
    groups: dict[int, list[tuple[int, int]]] = {}

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in groups:
                bisect.insort(gaps, gap)
                groups[gap] = []
            groups[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        while left := int(have.counts[length]):
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = groups[gap].pop()
                if not groups[gap]:
                    del groups[gap]
                    del gaps[at]
            else:
                gap, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            each = min(gap // length, left)
            used = min(n, left // each)
            put(length, first, used, each, capacity - gap)
            leave(gap - each * length, first, used)
            leave(gap, first + used, n - used)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id``, ``piece`` and ``length``.

    ``pieces`` is read three times, so hand over a written table.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    parts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n"))
    histogram = {int(r["length"]): int(r["n"]) for r in  # at most `capacity` rows
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = F.broadcast(spark.createDataFrame(plan_runs(histogram, capacity), RUN_SCHEMA))
    in_part = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = (salted.withColumn("_nth", F.row_number().over(in_part))
              .join(parts.select(F.col("length").alias("_l"), F.col("_salt").alias("_s"), "_before"),
                    (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s")))
              .withColumn("_rank", F.col("_before") + F.col("_nth") - 1))
    place = F.col("_rank") - F.col("first_rank")
    return (ranked.join(runs, (F.col("length") == F.col("run_length"))
                        & F.col("_rank").between(F.col("first_rank"), F.col("last_rank")))
            .select(*[F.col(c) for c in pieces.columns],
                    (F.col("first_sequence") + F.floor(place / F.col("per_sequence"))).cast("long").alias("sequence_id"),
                    (F.col("run_offset") + F.pmod(place, F.col("per_sequence")) * F.col("length")).cast("long")
                    .alias("offset")))


def packed_digests(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and offset; the ids as their CRC-32 (unsigned)."""
    pieces = token_pieces(docs, tokenizer_path, capacity)
    slim = cut(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")),
               "pieces")
    return pack(slim, capacity)


def packed_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its ids, its sequence and its offset there."""
    return pack(cut(token_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
