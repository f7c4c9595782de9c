"""Registered queries of the operators, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cordon.llm import (align, exact_dedup, line_dedup, mixing, neighbours, ngram_join, packing, pii, quality_knn, rules,
                        token_counts, url_rules, whitening)
from cordon.llm.shared import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def _held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op2_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_knn.fit(docs, labels.filter(~_held_out(F.col("doc_id"))))
    return quality_knn.score(docs, model).select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op3_line_dedup_two_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_digests(table(spark, sf_dir, "documents"), max_edits=2)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).drop("failed_rule")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_rows(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(table(spark, sf_dir, "documents"))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules_table = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules_table)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_sections(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"),
                                       public_tokenizers.PATTERN)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = align.align(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                        _tokenizer("piece_bpe_32k.model"), digest=True)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_knn": op2_quality_knn,
    "op3_line_dedup": op3_line_dedup,
    "op3_line_dedup_two_edits": op3_line_dedup_two_edits,
    "op4_quality_rules": op4_quality_rules,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_pii": op7_pii,
    "op8_url_rules": op8_url_rules,
    "op9_ngram_join": op9_ngram_join,
    "op10_token_counts": op10_token_counts,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLE: dict[str, str] = {}

# Words, lines and counts by SQL alone; the rules' order does not matter to the verdict.
ORACLE["op4_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w0 AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
w AS (SELECT rid, i, ws[i] AS word FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM w0)),
wc AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars,
              count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]')) AS with_letter,
              count(*) FILTER (regexp_matches(word, '[A-Z].*[A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS loud
       FROM w GROUP BY rid),
g0 AS (SELECT rid, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
       FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g0 WHERE c IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT j) AS n_repeat_words
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lc AS (SELECT rid, sum(n) AS lines, sum(n - 1) AS n_dup_lines
       FROM (SELECT rid, line, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line)
       GROUP BY rid),
c AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(lines, 0) AS lines, coalesce(with_letter, 0) AS with_letter, coalesce(loud, 0) AS loud
      FROM d LEFT JOIN wc USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lc USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 5 * n_symbols > n_words OR 2 * n_dup_lines > lines OR 5 * with_letter < 4 * n_words
            OR 10 * loud > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""

# Documents sorted by hash, which the operator never does: the budget is a prefix of that order.
ORACLE["op6_source_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap,
             1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
f AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source)),
k AS (SELECT sum(cap) FILTER (weight * level > cap) AS capped, sum(weight) FILTER (NOT weight * level > cap) AS free FROM f),
t AS (SELECT source, source_size,
             CASE WHEN weight * level > cap THEN cap::DOUBLE
                  ELSE weight * (((SELECT sum(source_size) FROM s) - coalesce((SELECT capped FROM k), 0))::DOUBLE / (SELECT free FROM k))
             END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(3, floor(target / source_size)) END AS epochs FROM t),
c AS (SELECT d.doc_id, d.source, size, sum(size) OVER (PARTITION BY d.source ORDER BY hash) AS upto,
             sum(size) OVER (PARTITION BY d.source, hash) AS own FROM d)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN epochs < 3 AND (upto <= target - epochs * source_size
            OR (upto - own <= target - epochs * source_size AND target - epochs * source_size - (upto - own) >= own / 2.0))
            THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c JOIN e ON c.source IS NOT DISTINCT FROM e.source
"""

ORACLE["op5_exact_dedup"] = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""

ORACLE["op8_url_rules"] = r"""
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM p),
r AS (SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

# Lines that share their first or last nine characters are compared (of twenty characters, one edit
# leaves one of the two untouched). DuckDB's edit distance counts bytes, so it only sorts out here.
ORACLE["op3_line_dedup"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, raw, trim(raw, ' ' || chr(9) || chr(13)) AS line
      FROM (SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS raw FROM d)),
f AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS nth FROM l),
u AS (SELECT doc_id, i, line, length(line) AS n FROM f WHERE nth = 1 AND length(line) >= 20),
c AS (SELECT a.doc_id, a.i, a.line AS x, b.line AS y FROM u a JOIN u b ON left(a.line, 9) = left(b.line, 9)
      WHERE (b.doc_id, b.i) < (a.doc_id, a.i) AND abs(a.n - b.n) <= 1
      UNION SELECT a.doc_id, a.i, a.line, b.line FROM u a JOIN u b ON right(a.line, 9) = right(b.line, 9)
      WHERE (b.doc_id, b.i) < (a.doc_id, a.i) AND abs(a.n - b.n) <= 1),
e AS (SELECT doc_id, i, CASE WHEN length(x) >= length(y) THEN x ELSE y END AS x, CASE WHEN length(x) >= length(y) THEN y ELSE x END AS y
      FROM c WHERE levenshtein(x, y) <= 4),
near AS (SELECT DISTINCT doc_id, i FROM e WHERE len(list_filter(range(1, length(x) + 1), lambda p:
         left(x, p - 1) = left(y, p - 1)
         AND substr(x, p + 1) = substr(y, CASE WHEN length(x) = length(y) THEN p + 1 ELSE p END))) > 0),
j AS (SELECT f.doc_id, f.i, f.raw, f.line, f.line <> '' AND f.nth > 1 AS equal, near.i IS NOT NULL AS near
      FROM f LEFT JOIN near ON f.doc_id = near.doc_id AND f.i = near.i)
SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (equal) AS n_equal_dropped,
       count(*) FILTER (near) AS n_near_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT (equal OR near)), '')) AS text_sha256
FROM j GROUP BY doc_id
"""
