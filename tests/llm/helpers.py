"""Small tables for the operators' tests, and plain Python versions of words and n-grams."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns with names that operators use themselves.
CLASHING = ("length", "hash", "size", "key", "label", "kept", "bucket", "tie", "n", "line", "pos", "start", "rule", "copies",
            "sequence_id", "offset", "score", "class_id")


def words(text):
    return WORD.findall(text or "")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_documents():
    """Nulls in every column, empty and very long texts, ties, repeated rows, near copies."""
    rng = random.Random(5)
    base = prose(rng, 120).split()
    near = base[:60] + ["changed"] + base[61:]
    far = base[:60] + prose(rng, 60).split()
    long = prose(rng, 40_000)
    texts = [" ".join(base), " ".join(near), " ".join(far), " ".join(base).upper(), "  ".join(base), "", None, "one two", "one two",
             long, "x" * 200_000, "\n".join(["same line of words here"] * 80), "tab\tand\x0bodd\x1cspaces é ünïcode",
             prose(rng, 70), prose(rng, 70), "Mail me.you+x@mail.example.com or +1 (415) 555-2671 now"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, "no id here " + prose(rng, 60), None, None, None), (None, None, None, None, None),
             (None, " ".join(base), "en", None, 3)]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_documents() if rows is None else rows, DOC_SCHEMA)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def names_in_plan(df):
    """Every column name that the plan of a frame uses."""
    return set(re.findall(r"(\w+)#\d+", df._jdf.queryExecution().analyzed().toString()))


def with_names_of(monkeypatch, module, run, df):
    """``df`` with a column for every name that ``run(df)`` uses inside, in all tables it writes on the way."""
    from pyspark.sql import functions as F

    used, cut = set(), module.cut
    monkeypatch.setattr(module, "cut", lambda frame, name: used.update(names_in_plan(frame)) or cut(frame, name))
    used |= names_in_plan(run(df))
    monkeypatch.undo()
    taken = {c.lower() for c in df.columns}
    clashing = sorted(n for n in used if n.lower() not in taken)
    assert len(clashing) > 5
    return df.withColumns({c: F.lit(f"own {c}") for c in clashing})
