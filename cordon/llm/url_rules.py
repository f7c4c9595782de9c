"""Url rules by a sort-merge range join, with Spark expressions only.

A rule is a host and a path; it fits that host and its subdomains where the url's path starts with
the rule's. The canonical key of (host, path) is the host's labels in reverse order followed by the
path, so all keys that a rule covers are an interval that starts at the rule's own key, and intervals
are nested or apart. A url stands for one key per ancestor of its host.

Urls' keys and rules' keys are sorted together within range buckets (sampled splitters over key and
page id, so a host with a third of all urls is divided); a rule goes to every bucket that its interval
touches. Each rule carries the stack of rules that enclose it. The sweep takes the stack of the last
rule at or before a url's key; of that stack the rules whose key the url's key starts with are the
active ones, and the last of them is the longest.

Edge cases: null urls and urls without ``://`` have empty host and path and fit no rule; an empty path
starts with no rule's path; repeated rows are judged alike and all returned; an empty table gives no
rows; of fitting rules of equal length the one with the longer host wins; if one (host, path) has both
verdicts, ``block`` holds; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cordon.llm.exact_dedup import LOWER, UPPER
from cordon.llm.ranges import bucket_of, sampled_splitters
from cordon.llm.shared import cut

DEFAULT_VERDICT = "allow"
FIRST_ID, LAST_ID = -(1 << 63), (1 << 63) - 1
BEYOND = "\U0010ffff"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def canonical_key(host: Column, path: Column) -> Column:
    return F.concat(F.array_join(_labels(host), "."), path)


def _stacks(rules: DataFrame) -> DataFrame:
    """One row per rule key: the key and its stack of enclosing rules, itself last."""
    one = (rules.select(canonical_key(F.col("host"), F.col("path")).alias("key"),
                        F.concat("host", "path").alias("rule"), "verdict")
           .groupBy("key").agg(F.min("rule").alias("rule"), F.max("verdict").alias("verdict")))  # block > allow
    starts = F.sequence(F.instr(F.col("key"), "/"), F.char_length("key"))
    prefixes = one.select(F.col("key").alias("inner"),
                          F.explode(F.transform(starts, lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("outer"))
    return (prefixes.join(one, F.col("outer") == F.col("key")).groupBy("inner")
            .agg(F.sort_array(F.collect_list(F.struct(
                F.char_length("key").alias("n"), F.instr("key", "/").alias("host_n"), "key", "rule", "verdict"))).alias("stack"))
            .withColumnRenamed("inner", "key"))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, id_col: str = "page_id") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each page; ``rules`` has ``host``, ``path`` (starting
    with a slash) and ``verdict`` (allow or block)."""
    url = F.col("url").cast("string")
    urls = (pages.select(F.col(id_col).cast("long").alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
            .groupBy("page_id", "host", "path").agg(F.count(F.lit(1)).alias("n")))
    labels = _labels(F.col("host"))
    keys = F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.col("path")))
    asked = cut(urls.select("*", F.explode(keys).alias("key")), "url-keys")
    ident = F.coalesce("page_id", F.lit(FIRST_ID))
    splitters = sampled_splitters(asked, F.col("key"), ident, asked.count())
    stacks = _stacks(rules)
    reach = F.sequence(bucket_of(F.col("key"), F.lit(FIRST_ID), splitters),
                       bucket_of(F.concat("key", F.lit(BEYOND)), F.lit(LAST_ID), splitters))
    events = asked.withColumn("bucket", bucket_of(F.col("key"), ident, splitters)).withColumn("kind", F.lit(1)) \
        .unionByName(stacks.select("key", "stack", F.explode(reach).alias("bucket")).withColumn("kind", F.lit(0)),
                     allowMissingColumns=True)
    sweep = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
    best = F.element_at(F.filter("open", lambda r: F.startswith(F.col("key"), r["key"])), -1)
    found = (swept.withColumn("best", F.when(F.size(F.filter("open", lambda r: F.startswith(F.col("key"), r["key"]))) > 0, best))
             .groupBy("page_id", "host", "path", "n").agg(F.max("best").alias("best")))  # the longest first
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
                        F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int"))).alias("copy")).drop("copy")
