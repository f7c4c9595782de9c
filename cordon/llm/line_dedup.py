"""Line deduplication over a deletion neighbourhood, with Spark expressions only.

A line is what ``\\n`` separates, without spaces, tabs and carriage returns at its ends; lines that are
then empty are left alone. Lines stand in the order (id, hash of the text, line number), null ids last.
Of equal lines the earliest stays. A line that stays so goes after all if an earlier, different line
lies within ``max_edits`` edits of it (characters inserted, deleted or replaced); both must have at least
``min_chars`` characters, as a few edits make another word of a shorter line (any bound above
``max_edits`` may be given).

All variants of a line of n characters would be about n ** k rows, so a filter that loses nothing comes
first. Of k + 1 segments one is untouched, with as many free places before it as segments, so the segment
lies moved by no more than that. Every line emits hashes of its segments (measured from the nearer end;
for two edits and more with lengths rounded down so that lines of nearly equal length have them in
common), and only lines with a hash that two different lines share go on: by a bitmap of bounded size while
it stays sparse, else by a semi-join of the hashes.

One edit: two lines within it have a deletion variant in common. Every line emits its variants as hashed
keys, a block of characters at a time, and only in blocks whose surroundings another line shares. Of the
lines that lack the same character of one variant the earliest is the witness for all others, so a group
of m lines makes m rows and no pairs.

More edits: two lines within k edits agree with one pattern, a text with k free places of which each holds
one character or none, and any two lines that agree with one pattern lie within k edits. The pattern is cut
into quarters, and every way to deal the free places (and those that are empty in this line) to them is a
row, with a hash of the parts without any. Rows whose hash no earlier line shares go; of at most ``GROUP``
rows with one hash all pairs are candidates; the parts of the others that have free places are halved, and
so on, down to the patterns themselves, whose earliest line is the witness for all others. The steps are
done for 1, 2, ... k edits; lines that went are only witnesses from then on.

Each candidate is verified with its witness by edit distance.

Line identities are 128-bit hashes. Edge cases: null text has one empty line; rows that share id and
text are one document and get equal rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cordon.llm.shared import cut, text_or_empty

MAX_EDITS = 1
MIN_CHARS = 20
BLOCK = 64
GROUP = 16  # rows that are compared pair by pair
BITMAP_WORDS = 1 << 17  # of 64 bits: 1 MB, and 131,072 rows at most in the broadcast
_SPACE = " \t\r"


def _tie(text_col: str) -> Column:
    return F.xxhash64(text_or_empty(text_col))


def _lines(docs: DataFrame, text_col: str) -> DataFrame:
    """``pos, line_id, line`` of every line that is not empty."""
    line = F.trim(F.col("col"), F.lit(_SPACE))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("tie"), F.col("pos").alias("line_no"))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tie(text_col).alias("tie"),
                        F.posexplode(F.split(text_or_empty(text_col), "\n")))
            .withColumn("line", line).filter(F.col("line") != "")
            .select(place.alias("pos"), F.unhex(F.md5(F.col("line").cast("binary"))).alias("line_id"), "line"))


def _rounded(n: Column) -> Column:
    """The three leading bits of a positive number, the others 0."""
    bits = F.greatest(F.floor(F.log2(n)).cast("int") - 2, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", n, bits), bits)


def _segments(line: Column, k: int) -> Column:
    """Hashes of what the untouched one of k + 1 segments may be, for all full lengths from n to n + k."""
    n = F.char_length(line)

    def of(size: Column) -> Column:
        keys = []
        for s in range(k + 1):
            for moved in range(min(s, k - s) + 1):
                at = size * s - moved if s <= k - s else n - size * (k - s + 1) + moved
                keys.append(F.xxhash64(F.lit(s), size, F.substring(line, at + 1, size)))
        return F.array(*keys)

    sizes = F.array_distinct(F.array(*[_rounded(F.floor((n + e) / (k + 1)).cast("int")) for e in range(k + 1)]))
    return F.array_distinct(F.flatten(F.transform(sizes, of)))


def _halves(line: Column) -> Column:
    """The same for one edit: of the longer line's length n the first n // 2, or the last n - n // 2 - 1."""
    n = F.char_length(line)

    def of(m: Column) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        return [F.xxhash64(F.lit(0), m, F.substring(line, F.lit(1), half)),
                F.xxhash64(F.lit(1), m, F.right(line, m - half - 1))]

    return F.array(*of(n), *of(n + 1))


def _word(key: Column) -> Column:
    return F.pmod(F.shiftright(key, 6), F.lit(BITMAP_WORDS)).cast("int")


def _bit(key: Column) -> Column:
    return F.pmod(key, F.lit(64)).cast("int")


def _candidates(lines: DataFrame, k: int, min_chars: int) -> DataFrame:
    """``line_id, line, pos`` (the earliest) of the lines that share a segment with another line."""
    long = lines.filter(F.char_length("line") >= min_chars)
    keys = _halves(F.col("line")) if k == 1 else _segments(F.col("line"), k)
    seen = F.xxhash64("line")
    shared = cut(long.select(F.explode(keys).alias("key"), seen.alias("l"))
                 .groupBy("key").agg(F.min("l").alias("a"), F.max("l").alias("b")).filter("a <> b").select("key"), "shared-segments")
    asked = long.select("*", F.explode(keys).alias("key"))
    if shared.count() <= BITMAP_WORDS * 64 // 8:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("key")))
        bitmap = cut(shared.groupBy(_word(F.col("key")).alias("word")).agg(F.bit_or(one).alias("bits")), "bitmap")
        hit = asked.withColumn("at", _word(F.col("key"))).join(
            F.broadcast(bitmap), (F.col("at") == F.col("word")) & (F.call_function("getbit", F.col("bits"), _bit(F.col("key"))) == 1))
    else:  # a full bitmap would let every line pass: keys meet by shuffle, without the texts
        ids = long.select("line_id", F.explode(keys).alias("key")).join(shared, "key", "left_semi").select("line_id").distinct()
        hit = long.join(ids, "line_id", "left_semi")
    return hit.groupBy("line_id").agg(F.min("pos").alias("pos"), F.first("line").alias("line"))


# -- one edit: deletion variants ----------------------------------------------------------------------

def _blocks(lines: DataFrame) -> DataFrame:
    """A row for each line, role and block of ``BLOCK`` characters: role 1 is the line itself (longer, or of
    equal length), role 2 the shorter line, seen as a line of one character more that has lost one in this
    block. ``around`` is a hash of what lies outside the block, which the one edit leaves untouched."""
    n = F.char_length("line")
    roles = F.explode(F.array(F.struct(F.lit(1).alias("role"), n.alias("m")), F.struct(F.lit(2).alias("role"), (n + 1).alias("m"))))
    cut_up = lines.select("line_id", "pos", "line", roles.alias("r")).select("line_id", "pos", "line", "r.role", "r.m")
    cut_up = cut_up.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / BLOCK).cast("int"))))
    start = F.col("block") * BLOCK
    after = F.greatest(F.col("m") - start - BLOCK, F.lit(0))
    middle = F.substring(F.col("line"), start + 1, F.char_length("line") - start - after)
    surroundings = F.xxhash64("m", "block", F.substring(F.col("line"), F.lit(1), start), F.right("line", after))
    return cut_up.select("line_id", "pos", "role", middle.alias("middle"), surroundings.alias("around"))


def _variant_pairs(found: DataFrame) -> DataFrame:
    """``line_id, witness`` of lines and earlier lines that have a deletion variant in common: the same
    place deleted in both (a replaced character), or deleted in one that is then the other (an inserted
    one). Variants are hashed, and are made only in blocks whose surroundings two lines share."""
    blocks = _blocks(found)
    shared = blocks.groupBy("around").agg(F.min("line_id").alias("a"), F.max("line_id").alias("b")).filter("a <> b")
    blocks = blocks.join(shared.select("around"), "around")
    middle = F.col("middle")
    lacking = F.transform(F.sequence(F.lit(1), F.char_length(middle)), lambda p: F.struct(
        F.xxhash64("around", F.concat(F.substring(middle, F.lit(1), p - 1), F.substring(middle, p + 1, F.char_length(middle)))).alias("key"),
        p.alias("place")))
    itself = F.array(F.struct(F.xxhash64("around", middle).alias("key"), F.lit(0).alias("place")))
    variants = cut(blocks.select("line_id", "pos", F.explode(F.when(F.col("role") == 1, lacking).otherwise(itself)).alias("v"))
                   .select("line_id", "pos", "v.key", "v.place"), "variants")
    first = (variants.filter("place > 0").groupBy("key", "place")
             .agg(F.min(F.struct("pos", "line_id")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    replaced = (variants.join(first, ["key", "place"]).filter(F.col("line_id") != F.col("first.line_id"))
                .select("line_id", F.col("first.line_id").alias("witness")))
    short = variants.filter("place = 0").select("key", F.col("line_id").alias("s_id"), F.col("pos").alias("s_pos"))
    apart = variants.filter("place > 0").join(short, "key").filter(F.col("line_id") != F.col("s_id"))
    later = F.col("pos") > F.col("s_pos")
    inserted = apart.select(F.when(later, F.col("line_id")).otherwise(F.col("s_id")).alias("line_id"),
                            F.when(later, F.col("s_id")).otherwise(F.col("line_id")).alias("witness"))
    return replaced.unionByName(inserted).distinct()


# -- more edits: patterns with free places ---------------------------------------------------------------

def _ways(part: Column, k: int) -> Column:
    """The two halves of a part with c free places, e of them empty, for every way to deal these: a hash of
    what has no free place, and the parts that have some. A part of free places alone stays as it is."""
    text, c, e = part["text"], part["c"], part["e"]
    full = F.char_length(text) + e
    first = F.shiftright(full + 1, 1)
    deals = F.array(*[F.struct(F.lit(c_).alias("c"), F.lit(e_).alias("e"), F.lit(c1).alias("c1"), F.lit(e1).alias("e1"))
                      for c_ in range(1, k + 1) for c1 in range(c_ + 1) for e_ in range(c_ + 1)
                      for e1 in range(max(0, e_ - c_ + c1), min(e_, c1) + 1)])
    fit = F.filter(deals, lambda w: (w["c"] == c) & (w["e"] == e) & (w["c1"] <= first) & (c - w["c1"] <= full - first))

    def halves(w: Column) -> Column:
        at = first - w["e1"]
        left, right = F.substring(text, F.lit(1), at), F.substring(text, at + 1, F.char_length(text))
        x = F.struct(left.alias("text"), w["c1"].alias("c"), w["e1"].alias("e"))
        y = F.struct(right.alias("text"), (c - w["c1"]).alias("c"), (e - w["e1"]).alias("e"))
        still = F.when(w["c1"] == 0, left).when(w["c1"] == c, right).otherwise(F.lit(""))
        parts = F.when(w["c1"] == 0, F.array(y)).when(w["c1"] == c, F.array(x)).otherwise(F.array(x, y))
        return F.struct(F.xxhash64(w["c1"], still).alias("hash"), parts.alias("parts"))

    stays = F.struct(F.lit(0).cast("long").alias("hash"), F.array(part).alias("parts"))
    none = F.struct(F.lit(0).cast("long").alias("hash"), F.filter(F.array(part), lambda x: x.isNotNull()).alias("parts"))
    return F.when(part.isNull(), F.array(none)).when(full == c, F.array(stays)).otherwise(F.transform(fit, halves))


def _finer(rows: DataFrame, k: int) -> DataFrame:
    """``line_id, pos, open, around, parts`` with all parts halved."""
    own = ["line_id", "pos", "open"]
    rows = rows.withColumn("finer", F.slice("parts", 1, 0))
    for i in range(k):  # k free places are in k parts at most
        rows = rows.select(*own, "around", "parts", "finer", F.explode(_ways(F.get("parts", F.lit(i)), k)).alias("w"))
        rows = rows.select(*own, F.xxhash64("around", "w.hash").alias("around"), "parts",
                           F.concat("finer", "w.parts").alias("finer"))
    return rows.select(*own, "around", F.col("finer").alias("parts"))


def _pairs(found: DataFrame, k: int) -> DataFrame:
    """``line_id, witness`` of open lines and earlier lines that may lie within k edits."""
    n = F.char_length("line")
    rows = found.withColumn("e", F.explode(F.array(*[F.lit(e) for e in range(k + 1)])))
    rows = rows.select("line_id", "pos", "open", F.xxhash64(n + F.col("e")).alias("around"),
                       F.array(F.struct(F.col("line").alias("text"), F.lit(k).alias("c"), F.col("e"))).alias("parts"))
    rows = _finer(_finer(rows, k), k)
    whole = F.forall("parts", lambda p: F.char_length(p["text"]) + p["e"] == p["c"])
    pairs = None
    while True:
        shared = cut(rows.groupBy("around").agg(F.min(F.struct("pos", "line_id")).alias("first"), F.max(F.when(F.col("open"), F.col("pos"))).alias("last"),
                                                F.count(F.lit(1)).alias("n")).filter(F.col("last") > F.col("first.pos"))
                     .select("around", "first", "n"), "shared-patterns")
        few = (rows.select("around", "pos", "line_id", "open").join(shared.filter(F.col("n") <= GROUP).select("around"), "around")
               .groupBy("around").agg(F.collect_set(F.struct("pos", "line_id", "open")).alias("a"))  # GROUP at most
               .select(F.explode("a").alias("x"), "a").filter("x.open").select("x", F.explode("a").alias("y"))
               .filter(F.col("y.pos") < F.col("x.pos"))
               .select(F.col("x.line_id").alias("line_id"), F.col("y.line_id").alias("witness")))
        many = cut(rows.join(shared.filter(F.col("n") > GROUP), "around").withColumn("whole", whole), "many-patterns")
        same = (many.filter(F.col("whole") & F.col("open") & (F.col("line_id") != F.col("first.line_id")))
                .select("line_id", F.col("first.line_id").alias("witness")))
        step = cut(few.unionByName(same).distinct(), "near-pairs")
        pairs = step if pairs is None else pairs.unionByName(step)
        many = many.filter(~F.col("whole"))
        if many.isEmpty():
            return pairs.distinct()
        rows = _finer(many, k)


def _near(lines: DataFrame, max_edits: int, min_chars: int) -> DataFrame:
    """``pos`` of the lines that have an earlier line within so many edits."""
    found = cut(_candidates(lines, max_edits, min_chars), "candidate-lines")
    other = found.select(F.col("line_id").alias("witness"), F.col("line").alias("other"))

    def verified(pairs: DataFrame, k: int) -> DataFrame:
        return (pairs.join(found, "line_id").join(other, "witness")
                .filter(F.levenshtein("line", "other", k).between(0, k)).select("line_id", "pos").distinct())

    if max_edits == 1:
        return verified(_variant_pairs(found), 1).select("pos")
    near = None
    for k in range(1, max_edits + 1):
        rows = found.withColumn("open", F.lit(True))
        if near is not None:
            rows = found.join(near.select("line_id", F.lit(True).alias("went")), "line_id", "left") \
                .select(*found.columns, F.col("went").isNull().alias("open"))
        step = cut(verified(_pairs(rows, k), k), "near-lines")
        near = step if near is None else near.unionByName(step)
    return near.select("pos")


def dedup_lines(docs: DataFrame, text_col: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, the ``text`` without the lines that go, ``n_lines`` (not empty), ``n_equal_dropped`` and
    ``n_near_dropped`` for every document."""
    if not 1 <= max_edits < min_chars:
        raise ValueError("max_edits must be at least 1 and below min_chars")
    lines = _lines(docs, text_col)
    slim = cut(lines.select("pos", "line_id"), "lines")
    groups = slim.groupBy("line_id").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    equal = slim.join(groups, "line_id").filter(F.col("pos") != F.col("first")).select("pos", F.lit(True).alias("equal"))
    gone = equal.unionByName(_near(lines, max_edits, min_chars).withColumn("equal", F.lit(False)))
    number = F.col("pos.line_no")
    per_doc = (gone.groupBy(F.col("pos.doc_id").alias("g_id"), F.col("pos.tie").alias("g_tie"))
               .agg(F.collect_set(F.when(F.col("equal"), number)).alias("equal"),
                    F.collect_set(F.when(~F.col("equal"), number)).alias("near")))
    none = F.array().cast("array<int>")
    text = text_or_empty(text_col)
    split = F.split(text, "\n")
    out = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _tie(text_col).alias("tie"))
           .join(per_doc, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("tie") == F.col("g_tie")), "left")
           .withColumn("equal", F.coalesce("equal", none)).withColumn("near", F.coalesce("near", none)))
    split = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.concat("equal", "near"))
    kept = F.when(F.size("equal") + F.size("near") == 0, F.col("text")) \
        .otherwise(F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n"))
    full = F.size(F.filter(split, lambda x: F.trim(x, F.lit(_SPACE)) != ""))
    return out.select("doc_id", kept.alias("text"), full.cast("long").alias("n_lines"),
                      F.size("equal").cast("long").alias("n_equal_dropped"), F.size("near").cast("long").alias("n_near_dropped"))


def dedup_digests(docs: DataFrame, text_col: str = "text", max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The same with the remaining text as SHA-256."""
    return dedup_lines(docs, text_col, max_edits, min_chars).select(
        "doc_id", "n_lines", "n_equal_dropped", "n_near_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
