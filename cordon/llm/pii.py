"""Personal data by weak supervision, with Spark expressions only.

Candidates are matches of fixed patterns (e-mail, IP address, card and phone number) and of looser forms:
addresses with the at sign or the dots spelt out, cards of 13 digits or in groups that other marks part, and phone
numbers as written within North America, Germany, France and Spain. Matches that meet their kind's conditions
are base spans and always reported. Five labelers vote on every candidate, for, against or not at all:

- ``form``: whether it has the strict form and meets the conditions;
- ``check``: checksum, ranges, counts of digits;
- ``gazetteer``: known top-level domains, issuers' first digits, country and area codes;
- ``context``: words before the span that announce such data, or other numbers;
- ``edges``: whether the span stands alone or is part of a longer word.

Votes are counted by pattern, of which there are a few thousand at most however many documents there
are. Expectation maximisation over these counts (``reliabilities``) estimates how often each labeler
is right for each kind, and with that each pattern's probability. A logistic regression on votes and
shape, trained on those probabilities, is the final span classifier; it becomes one Spark expression.
Candidates that are not base spans are added if it gives them at least ``ADD_AT``, unless they overlap
a base span.

Positions are code points, found from the lengths of the matches and of the text between them, so the
text is read by each pattern once. The patterns use possessive loops and start only where a match can
start, so their time is linear in the text. Candidates are written without text before the statistics.

Edge cases: null text is empty and has no spans; without candidates nothing is added; repeated rows get
equal rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from cordon.llm.shared import cut, text_or_empty

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("form", "check", "gazetteer", "context", "edges")
ADD_AT = 0.9
CONTEXT_CHARS = 40
ROUNDS = 50
PART = 256  # spans of a text that are appended in one go

_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
# A run is tried at its start or where the last match ended; starts further inside cannot match.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# Looser forms. The at sign in brackets, or as a word if the dots are words as well.
_DOT = r"(?:\.| ?[\[({](?:dot|DOT|punkt|point|punto)[\])}] ?)"
SPELT_EMAIL = (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++(?: ?[\[({{](?:at|AT|arroba|arobase)[\])}}] ?[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"
               r"| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++)")
SPELT_SIGN = r"[\[({](?:at|AT|arroba|arobase)[\])}]| at [A-Za-z0-9-]++ dot "
LOOSE_CARD = (r"(?<![0-9])(?:4(?:[ -]?[0-9]){12}(?![ -]?[0-9])"
              r"|[0-9]{4}(?:(?:[._/ ]| ?- ?| {2})[0-9]{4}){3}(?![0-9]))")
LOCAL_PHONE = (r"(?<![0-9+.-])(?:\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"  # North America
               r"|0[1-9](?:[ .-][0-9]{2}){4}"  # France
               r"|\(?0[1-9][0-9]{1,4}(?:\) ?|[ /-])[0-9]{3,5}(?:[ -]?[0-9]{2,4})?"  # Germany
               r"|[6-9][0-9]{2}(?: [0-9]{3}){2})(?![0-9]|[.-][0-9])")  # Spain

OCTETS = r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|\z)){4}\z"
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|mil|int|info|biz|io|de|fr|es|uk|it|nl|at|ch|eu|us|ca|au|in|jp|cn|br|mx)\z"
ISSUERS = r"\A(?:4|5[1-5]|2[2-7]|3[47]|6011|65|64[4-9]|35|36|38|62)"
COUNTRIES = r"\A\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
AREAS = r"\A(?:[2-9][0-9]{2}[2-9][0-9]{6}\z|0[1-9]|[6-9][0-9]{8}\z)"
RESERVED = r"\A0*(?:0|127|255|22[4-9]|23[0-9]|24[0-9]|25[0-4])\."
ANNOUNCES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach|correo|courriel|adresse|kontakt|contacto|escriba|schreib\w*|écri\w*)\b",
    "ip": r"(?i)\b(?:ip|server|host|address|login|from|adresse|dirección|servidor|serveur)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|\w*karte|carte|paiement|tarjeta|pago|zahlung)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|cell|telefon|telefax|handy|ruf\w*|téléphone|tél|portable|appel\w*|teléfono|móvil|llam\w*)\b",
}
OTHER_NUMBERS = r"(?i)\b(?:version|isbn|order|invoice|serial|reference|ref|id|no|nr|page|section|release|rechnung|bestellung|seite|facture|commande|factura|pedido|página)\W*\z"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _sweep(items: Column, none: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``aggregate`` of items to the array ``out`` of a state ``at, out`` that starts with 0 and an empty array. The
    items go through in parts, so an append copies a part at most and a text of many spans takes no square of them."""
    def parts(every: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(every) - 1, F.lit(0)) / PART).cast("int")),
                           lambda i: F.slice(every, i * PART + 1, F.lit(PART)))

    def part(state: Column, some: Column) -> Column:
        swept = F.aggregate(some, F.struct(state["at"].alias("at"), none.alias("out")), step)
        return _let(swept, lambda s: F.struct(s["at"].alias("at"), F.concat(state["outs"], F.array(s["out"])).alias("outs")))

    start = F.struct(F.lit(0).alias("at"), F.slice(F.array(none), 1, 0).alias("outs"))
    return F.aggregate(_let(items, parts), start, part, lambda state: F.flatten(state["outs"]))


def _matches(text: Column, pattern: str) -> Column:
    """Array of ``start, end, hit, before, after`` of the pattern's matches."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def joined(gaps: Column) -> Column:
        pairs = F.zip_with(gaps, hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
        return F.zip_with(pairs, F.slice(gaps, F.lit(2), F.size(gaps)), lambda p, following: F.struct(
            p["gap"].alias("gap"), p["hit"].alias("hit"), following.alias("following")))

    none = F.array().cast("array<struct<start:int,end:int,hit:string,before:string,after:string>>")

    def step(state: Column, z: Column) -> Column:
        start = state["at"] + F.char_length(z["gap"])
        end = start + F.coalesce(F.char_length(z["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), z["hit"].alias("hit"),
                        F.right(z["gap"], F.lit(CONTEXT_CHARS)).alias("before"),
                        F.left(F.coalesce(z["following"], F.lit("")), F.lit(1)).alias("after"))
        return F.struct(end.alias("at"), F.when(z["hit"].isNull(), state["out"])
                        .otherwise(F.concat(state["out"], F.array(span))).alias("out"))

    return _sweep(_let(F.split(text, pattern, -1), joined), none, step)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(state: Column, c: Column) -> Column:
        d = F.try_to_number(c, F.lit("9")).cast("int") * (state["i"] % 2 + 1)
        return F.struct((state["i"] + 1).alias("i"), (state["sum"] + F.when(d > 9, d - 9).otherwise(d)).alias("sum"))

    total = F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum")), step,
                        lambda state: state["sum"])
    return total % 10 == 0


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, -1 against, 0 no vote; without ``no`` it is for or against."""
    against = F.when(no, -1).otherwise(0) if no is not None else F.lit(-1)
    return F.coalesce(F.when(yes, 1).otherwise(against), F.lit(0))


def _judged(kind: str, strict: bool) -> Callable[[Column], Column]:
    """Votes and shape of one match."""

    def judge(m: Column) -> Column:
        hit = m["hit"]
        digits = _digits(hit)
        count = F.char_length(digits)
        if kind == "email":
            plain = hit if strict else F.regexp_replace(hit, r" ?[\[({](?:dot|DOT|punkt|point|punto)[\])}] ?| dot ", ".")
            check, known = F.length(F.substring_index(plain, ".", -1)).between(2, 24), plain.rlike(DOMAINS)
            holds, size = F.lit(True), F.lit(0)
        elif kind == "ip":
            holds = hit.rlike(OCTETS)
            check, known, size = holds, ~hit.rlike(RESERVED), F.lit(0)
        elif kind == "card":
            holds = F.when(count.between(14 if strict else 13, 19), _luhn(digits)).otherwise(False)
            check, known, size = holds, digits.rlike(ISSUERS), F.when(count == 16, 2).when(count.between(13, 19), 1).otherwise(0)
        else:
            holds = count.between(10, 15) if strict else count.between(8, 12)
            check = holds
            known = hit.rlike(COUNTRIES) if strict else digits.rlike(AREAS)
            size = F.when(count.between(10, 12), 2).when(holds, 1).otherwise(0)
        base = holds if strict else F.lit(False)
        word = r"[\p{L}0-9]"
        alone = ~m["before"].rlike(word + r"\z") & ~m["after"].rlike(r"\A" + word)
        return F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"), base.alias("base"),
            _vote(base, ~base if strict else F.lit(False)).alias("form"), _vote(check).alias("check"),
            _vote(known).alias("gazetteer"),
            _vote(m["before"].rlike(ANNOUNCES[kind]), m["before"].rlike(OTHER_NUMBERS)).alias("context"),
            _vote(alone).alias("edges"), size.cast("int").alias("size"))

    return judge


SPANS = ("array<struct<start:int,kind:int,end:int,base:boolean,form:int,check:int,gazetteer:int,context:int,"
         "edges:int,size:int>>")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: base spans and looser candidates apart from them, by start and kind."""
    text = F.col("text")
    none = F.array().cast(SPANS)

    def of(kind: str, pattern: str, strict: bool, sign: Column) -> Column:
        return F.when(sign, F.transform(_matches(text, pattern), _judged(kind, strict)).cast(SPANS)).otherwise(none)

    number = text.rlike("[0-9]")
    strict = F.concat(of("email", EMAIL, True, F.contains(text, F.lit("@"))), of("ip", IP, True, number),
                      of("card", CARD, True, number), of("phone", PHONE, True, F.contains(text, F.lit("+"))))
    loose = F.concat(of("email", SPELT_EMAIL, False, text.rlike(SPELT_SIGN)), of("card", LOOSE_CARD, False, number),
                     of("phone", LOCAL_PHONE, False, number))

    def apart(spans: Column) -> Column:
        base = F.filter(spans, lambda s: s["base"])
        other = F.concat(F.filter(spans, lambda s: ~s["base"]), F.col("loose"))
        # A base span opens at its start, before any other span that ends further on; ``at`` is the last base end so far.
        events = F.array_sort(F.transform(F.concat(base, other), lambda s: F.struct(
            F.when(s["base"], s["start"]).otherwise(s["end"]).alias("pos"), s["base"].alias("base"), s.alias("span"))))

        def free(state: Column, e: Column) -> Column:
            alone = ~e["base"] & (state["at"] <= e["span"]["start"])
            return F.struct(F.when(e["base"], F.greatest(state["at"], e["span"]["end"])).otherwise(state["at"]).alias("at"),
                            F.when(alone, F.concat(state["out"], F.array(e["span"]))).otherwise(state["out"]).alias("out"))

        return F.when(F.size(other) == 0, F.array_sort(base)).otherwise(F.array_sort(F.concat(base, _sweep(events, none, free))))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .select("doc_id", strict.alias("strict"), loose.alias("loose"))
            .select("doc_id", _let(F.col("strict"), apart).alias("spans")))


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Expectation maximisation over vote patterns: each pattern's probability, and how often each labeler
    that votes is right. A labeler counts as better than chance throughout."""
    right = np.full(votes.shape[1], 0.8)
    prior = 0.5
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + votes @ np.log(right / (1 - right))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        agree = np.where(votes > 0, p[:, None], np.where(votes < 0, 1 - p[:, None], 0))
        cast = (votes != 0) * counts[:, None]
        right = np.clip((8 + (agree * counts[:, None]).sum(axis=0)) / (10 + cast.sum(axis=0)), 0.55, 0.98)
        prior = float(np.clip((1 + (p * counts).sum()) / (2 + counts.sum()), 0.02, 0.98))
    return p, right


def regression(x: np.ndarray, p: np.ndarray, counts: np.ndarray, steps: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the first weight is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    counts = counts / max(counts.sum(), 1) * min(counts.sum(), 10_000)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (p - q)) - ridge * w
        curve = (x * (counts * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(curve, slope)
    return w


def train(spans: DataFrame) -> list[list[float]]:
    """Weights of the span classifier for each kind: intercept, labelers, size."""
    names = ["kind", *LABELERS, "size"]
    found = (spans.select(F.explode("spans").alias("s")).select(*[F.col(f"s.{c}").alias(c) for c in names])
             .groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect())  # at most 4 * 3^5 * 3 rows
    out = []
    for kind in range(len(KINDS)):
        rows = [r for r in found if r["kind"] == kind]
        if not rows:
            out.append([0.0] * (len(LABELERS) + 2))
            continue
        votes = np.array([[r[c] for c in LABELERS] for r in rows], dtype=float)
        counts = np.array([r["n"] for r in rows], dtype=float)
        p, _ = reliabilities(votes, counts)
        x = np.column_stack([votes, [r["size"] for r in rows]])
        out.append([float(v) for v in regression(x, p, counts)])
    return out


def _probability(span: Column, weights: list[list[float]]) -> Column:
    score = None
    for kind, w in enumerate(weights):
        value = F.lit(w[0])
        for name, weight in zip((*LABELERS, "size"), w[1:]):
            value = value + F.lit(weight) * span[name]
        score = F.when(span["kind"] == kind, value) if score is None else score.when(span["kind"] == kind, value)
    return 1 / (1 + F.exp(-score))


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id, base, spans``: arrays of spans (start, kind, end, ...) by start, then kind as listed."""
    found = cut(candidates(docs, text_col), "spans")
    weights = train(found)
    return found.select("doc_id", F.filter("spans", lambda s: s["base"]).alias("base"),
                        F.filter("spans", lambda s: s["base"] | (_probability(s, weights) >= ADD_AT)).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.array_distinct(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))), ",")


def span_digests(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Counts of the base spans, their list as SHA-256, and all spans as text."""
    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return find_spans(docs, text_col).select(
        "doc_id", *[count(k) for k in range(len(KINDS))],
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
