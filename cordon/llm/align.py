"""Alignment of two tokenizers' tokens over the same bytes, Arrow-native.

A document is encoded by a byte-level vocabulary (A, of a space and the text) and by a piece vocabulary
(B, which adds that space itself). Documents are taken in chunks of about ``CHUNK_BYTES``; all work on a
chunk is done on Arrow columns:

1. The token lists are flattened with their parent indices; a token's end in its document is the running
   sum of token lengths less the sum before the document.
2. An Acero full outer hash join of A's and B's ends on (document, end) gives, in order, the places where
   either cuts the text. The stretch before each place lies in one A token and one B token, and every
   overlapping pair has exactly one such stretch, so these rows are the links; the next token's id is filled
   in backwards. Where both cut, a group ends.
3. ``Table.group_by`` counts the links of each document and id pair, and the documents of each id pair.

Spark adds the chunks' partial counts by id pair, finds each A id's highest count, and brings the counts
back to the chunks that hold the pair: one row per chunk and pair travels, not one per link, so a pair that
all documents hold is one row a chunk. The documents' links are never shuffled by pair.

A chunk is written as a row for each document, with its links, and a row of the chunk's id pairs, so no row
grows with the number of documents; a chunk's rows meet its counts in a cogroup, one chunk at a time.

Texts that are null or empty, or whose joined token bytes differ from the space and the text, have no
tokens: zeros and an empty string. Repeated rows count each, null ids are kept, an empty table gives no
rows, and columns other than the id and the text are not read. A very long text is a chunk of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cordon.llm.shared import cut
from cordon.llm.token_counts import byte_tokens

CHUNK_BYTES = 2 << 20
_DOC_BITS = 40  # a document has fewer bytes than 2 ** 40

# Of the written chunks. Spark's reader holds up to 4,096 rows of a row group, decoded, whatever their width.
ROW_GROUP_BYTES = 16 << 20

DOC_FIELDS = "doc_id long, n_a int, n_b int, n_groups int, n_links int, groups string"
DOC_LINKS = "link_pair array<int>, link_n array<int>"
CHUNK_PAIRS = "a array<int>, b array<int>, pair_docs array<int>"
CHUNK_SCHEMA = f"chunk long, {DOC_FIELDS}, {DOC_LINKS}, {CHUNK_PAIRS}"
OUT_SCHEMA = DOC_FIELDS.replace(" int", " long") + ", n_best long, count_sum long"


class PieceTokens:
    """A piece vocabulary with the bytes that every piece stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(self.model.id_to_piece(list(range(n))))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


_pieces: dict[str, PieceTokens] = {}


def piece_tokens(path: str) -> PieceTokens:
    if path not in _pieces:
        _pieces[path] = PieceTokens(path)
    return _pieces[path]


@dataclass
class Vocabulary:
    """Token ids to their bytes, as Arrow arrays."""

    bytes: pa.Array
    lengths: pa.Array

    @classmethod
    def of(cls, tokens: list[bytes]) -> "Vocabulary":
        return cls(pa.array(tokens, pa.binary()), pa.array([len(t) for t in tokens], pa.int64()))

    def joined(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list's tokens."""
        return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, self.bytes.take(lists.flatten())), b"")


def _lists(ids: list[list[int]]) -> pa.ListArray:
    sizes = np.array([len(x) for x in ids], dtype=np.int32)
    flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(sizes.sum()))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat))


def _kept(lists: pa.ListArray, keep: np.ndarray) -> pa.ListArray:
    """The lists, those not kept without their values."""
    if keep.all():
        return lists
    sizes = np.diff(lists.offsets.to_numpy())
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(keep, sizes, 0)))).astype(np.int32)),
                                    lists.values.filter(pa.array(np.repeat(keep, sizes))))


def document_ends(lists: pa.ListArray, lengths: pa.Array) -> pa.Table:
    """``key, id`` of all tokens; the key holds the document and the byte at which the token ends there."""
    doc = pc.list_parent_indices(lists)
    ids = pc.list_flatten(lists)
    upto = pc.cumulative_sum(lengths.take(ids))
    begin = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), upto]), lists.offsets[:-1])  # the sum before each document
    end = pc.subtract(upto, begin.take(doc))
    return pa.table({"key": pc.bit_wise_or(pc.shift_left(doc.cast(pa.int64()), _DOC_BITS), end), "id": ids})


def _group_texts(lists: pa.ListArray, ends_group: pa.Array) -> pa.Array:
    """The ids of each group, joined by commas; ``ends_group`` is how many tokens lie up to each group's end."""
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends_group.cast(pa.int32())])
    return pc.binary_join(pa.ListArray.from_arrays(offsets, lists.flatten().cast(pa.string())), ",")


def align_texts(a_lists: pa.ListArray, b_lists: pa.ListArray, wanted: list[bytes], a: Vocabulary, b: Vocabulary) -> dict:
    """Alignment of the texts of one chunk, given by their token ids and the bytes both must stand for."""
    expected = pa.array(wanted, pa.binary())
    same = pc.and_(pc.equal(a.joined(a_lists), expected), pc.equal(b.joined(b_lists), expected)).to_numpy(zero_copy_only=False)
    a_lists, b_lists = _kept(a_lists, same), _kept(b_lists, same)
    cuts = document_ends(a_lists, a.lengths).rename_columns(["key", "a"]) \
        .join(document_ends(b_lists, b.lengths).rename_columns(["key", "b"]), "key", join_type="full outer", use_threads=False) \
        .sort_by("key").combine_chunks()
    key, at_a, at_b = (_one(cuts.column(c)) for c in ("key", "a", "b"))
    doc = pc.shift_right(key, _DOC_BITS)
    del cuts, key
    of_a, of_b = at_a.is_valid(), at_b.is_valid()
    both = pc.and_(of_a, of_b)
    upto_a = pc.cumulative_sum(of_a.cast(pa.int64())).filter(both)
    upto_b = pc.cumulative_sum(of_b.cast(pa.int64())).filter(both)
    groups = pc.binary_join_element_wise(_group_texts(a_lists, upto_a), _group_texts(b_lists, upto_b), "|")
    n = len(wanted)
    n_groups = np.bincount(doc.filter(both).to_numpy(), minlength=n)
    n_links = np.bincount(doc.to_numpy(), minlength=n)
    group_offsets = pa.array(np.concatenate(([0], np.cumsum(n_groups))).astype(np.int32))
    texts = pc.binary_join(pa.ListArray.from_arrays(group_offsets, groups), ";")
    code = pc.bit_wise_or(pc.shift_left(pc.fill_null_backward(at_a).cast(pa.int64()), 32), pc.fill_null_backward(at_b).cast(pa.int64()))
    coded = code.dictionary_encode()
    del at_a, at_b, of_a, of_b, both, upto_a, upto_b, groups, code
    width = max(1, len(coded.dictionary))
    per_doc = pa.table({"at": pc.add(pc.multiply(doc, width), coded.indices.cast(pa.int64()))}) \
        .group_by("at", use_threads=False).aggregate([([], "count_all")])
    at = _one(per_doc.column("at"))
    link_doc = pc.divide(at, width)
    link_pair = pc.subtract(at, pc.multiply(link_doc, width)).cast(pa.int32())
    by_doc = pa.array(np.argsort(link_doc.to_numpy(), kind="stable"))
    link_offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(link_doc.to_numpy(), minlength=n)))).astype(np.int32))
    pair_docs = pa.table({"pair": link_pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
    return {
        "n_a": pc.list_value_length(a_lists), "n_b": pc.list_value_length(b_lists),
        "n_groups": pa.array(n_groups.astype(np.int32)), "n_links": pa.array(n_links.astype(np.int32)), "groups": texts,
        "a": pc.shift_right(coded.dictionary, 32).cast(pa.int32()),
        "b": pc.bit_wise_and(coded.dictionary, pa.scalar((1 << 32) - 1, pa.int64())).cast(pa.int32()),
        "pair_docs": _one(pair_docs.column("count_all")).cast(pa.int32()),
        "link_pair": pa.ListArray.from_arrays(link_offsets, link_pair.take(by_doc)),
        "link_n": pa.ListArray.from_arrays(link_offsets, _one(per_doc.column("count_all")).cast(pa.int32()).take(by_doc)),
    }


def _one(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    if isinstance(column, pa.Array):
        return column
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else \
        pa.array([], column.type)


def _chunk_rows(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_BYTES``; a longer text is a range of its own."""
    size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(size, size[i] + CHUNK_BYTES, side="right")) - 1)
        yield i, min(j, len(texts))
        i = j


def _rows(schema: pa.Schema, chunk: int, n: int, values: dict, names: list[str]) -> pa.RecordBatch:
    """``n`` rows of a chunk that have these columns only."""
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, chunk, np.int64)), *[values[f.name].cast(f.type) if f.name in names else pa.nulls(n, f.type)
                                                  for f in list(schema)[1:]]], schema=schema)


def aligned_chunks(docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, digest: bool = False,
                   text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """For each chunk a row per document, with the places of its id pairs in the chunk's list and the number
    of links of each, and one row (``a`` is not null) with that list: the chunk's id pairs and their document
    counts. Written once. With ``digest`` the groups are held as SHA-256."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(CHUNK_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, pieces = byte_tokens(ranks_path, pattern), piece_tokens(pieces_path)
        a, b = Vocabulary.of(ranks.tokens()), Vocabulary.of(pieces.bytes)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi in _chunk_rows(batch.column(1)):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                full = [i for i, t in enumerate(texts) if t]
                ids = [[]] * len(texts)
                for i, of_text in zip(full, pieces.encode([texts[i] for i in full])):
                    ids[i] = of_text
                b_lists = _lists(ids)
                ids = of_text = None  # the ids of a chunk take several times its bytes as Python's integers
                a_lists = _lists([ranks.encode(" " + t) if t else [] for t in texts])
                found = align_texts(a_lists, b_lists, [(" " + t).encode() if t else b"" for t in texts], a, b)
                if digest:
                    found["groups"] = pa.array([hashlib.sha256(g.as_buffer()).hexdigest() if n else "" for g, n in
                                                zip(found["groups"], found["n_a"].to_numpy().tolist())])
                found["doc_id"] = batch.column(0).slice(lo, hi - lo)
                yield _rows(schema, chunk, hi - lo, found, schema.names[1:-3])
                yield _rows(schema, chunk, 1, {c: pa.ListArray.from_arrays(pa.array([0, len(found[c])], pa.int32()), found[c])
                                               for c in schema.names[-3:]}, schema.names[-3:])
                chunk += 1
                pa.default_memory_pool().release_unused()

    return cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
               .mapInArrow(run, CHUNK_SCHEMA), "aligned-chunks", **{"parquet.block.size": ROW_GROUP_BYTES})


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``a, b, n_docs, best``: how many documents hold an id pair linked, and whether that is its A id's
    highest; written once."""
    totals = cut(chunks.select(F.explode(F.arrays_zip("a", "b", "pair_docs")).alias("p"))
                 .groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("p.pair_docs").alias("n_docs")), "pair-counts")
    highest = totals.groupBy(F.col("a").alias("of")).agg(F.max("n_docs").alias("most"))
    return totals.join(highest, F.col("a") == F.col("of")).select("a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _sums(lists: pa.ListArray, values: np.ndarray) -> pa.Array:
    """The sum of each list's values."""
    upto = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return pa.array(upto[offsets[1:]] - upto[offsets[:-1]])


def _scored(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The result's rows of one chunk."""
    pair, times = _one(docs.column("link_pair")), _one(docs.column("link_n")).flatten().to_numpy().astype(np.int64)
    at = pair.flatten().to_numpy()
    n_docs, best = (np.zeros(counts.num_rows, np.int64) for _ in range(2))  # by place in the chunk's list
    pos = counts.column("pos").to_numpy()
    n_docs[pos] = counts.column("n_docs").to_numpy()
    best[pos] = counts.column("best").cast(pa.int64()).to_numpy()
    names = [f.split()[0] for f in OUT_SCHEMA.split(", ")]
    return pa.table([docs.column("doc_id"), *[docs.column(c).cast(pa.int64()) for c in names[1:5]], docs.column("groups"),
                     _sums(pair, best[at] * times), _sums(pair, n_docs[at] * times)], names=names)


def align(docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str, digest: bool = False,
          text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``; ``n_a, n_b`` tokens; ``n_groups``; ``n_links``; ``groups``, the ids of
    each group as ``a1,a2|b1;a3|b2,b3`` (or its SHA-256); ``n_best``, the links whose id pair has its A id's
    highest document count; ``count_sum``, the sum of the links' counts."""
    chunks = aligned_chunks(docs, ranks_path, pattern, pieces_path, digest, text_col, id_col)
    counts = pair_counts(chunks)
    held = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "p")) \
        .select("chunk", "pos", F.col("p.a").alias("ca"), F.col("p.b").alias("cb"))
    back = held.join(counts, (F.col("ca") == F.col("a")) & (F.col("cb") == F.col("b"))).select(F.col("chunk").alias("of"), "pos", "n_docs", "best")
    return (chunks.filter(F.col("a").isNull()).drop("a", "b", "pair_docs").groupBy("chunk")
            .cogroup(back.groupBy("of")).applyInArrow(_scored, OUT_SCHEMA))
