"""Operators that make rows out of texts: claims, captions, metrics, timelines, action items and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.predicates import claim_class
from leafmill.functions.text import strip

# Fixed value: how a claim names the one it depends on.
DEPENDS = r"(?i)(?:of|according to|as (?:defined|claimed) in)\s+(?:any\s+(?:one\s+)?of\s+)?claims?\s+(\d+)"
# Fixed values: (kind, pattern, group) of the figures that a deck states.
METRICS = (
    ("percentage", r"(\d+(?:\.\d+)?)\s*%"),
    ("sample_size", r"(?:n\s*=\s*|N\s*=\s*)(\d+)"),
    ("p_value", r"(?:p\s*[<>=]\s*)(\d+\.\d+)"),
    ("ratio", r"(?:HR|OR|RR)\s*[=:]\s*(\d+\.\d+)"),
    ("dosage", r"(\d+(?:\.\d+)?)\s*(?:mg|µg|ng|mL|µL)"),
)
# Labels of a timeline, by quarter, year and month.
TIMELINES = tuple(rf"(?i)({label})\s*[:\-–]\s*([^\n]+)" for label in (r"Q[1-4]\s*(?:19[7-9]\d|20\d{2})", r"(?:19[7-9]\d|20\d{2})", r"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\w*\s+(?:19[7-9]\d|20\d{2})"))
OWNER = r"\b([A-Z][a-z]+ [A-Z][a-z]+)\b"
DEADLINE = r"(\d{1,2}[./]\d{1,2}[./]\d{2,4}|\d{4}-\d{2}-\d{2}|Q[1-4]\s*\d{4})"
IDS = r"[A-Z]{2,4}-\d{3,6}"


def claims(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, number, text, depends_on, is_independent, category) of each numbered claim; of equal numbers the last."""
    parts = F.split(F.concat(F.lit("\n"), strip(F.col(text))), r"\n(?=\d+\.\s)")
    rows = df.select(key, F.posexplode(parts).alias("ord", "part")).filter(F.col("part").rlike(r"^\d+\.\s"))
    body = strip(F.regexp_extract("part", r"(?s)^\d+\.\s+(.*)$", 1))
    parsed = rows.select(key, "ord", F.regexp_extract("part", r"^(\d+)\.", 1).cast("int").alias("number"), body.alias("claim"))
    last = parsed.withColumn("__n", F.row_number().over(Window.partitionBy(key, "number").orderBy(F.desc("ord")))).filter("__n = 1")
    depends = F.nullif(F.regexp_extract("claim", DEPENDS, 1), F.lit("")).cast("int")
    return last.select(key, "number", "claim", depends.alias("depends_on"), depends.isNull().alias("is_independent"), claim_class(F.col("claim")).alias("category"))


def captions(df: DataFrame, key: str, text: str, word: str = "(?:Figure|Fig\\.?)", longest: int = 500) -> DataFrame:
    """(key, number, ord, caption): 'Figure n. text' up to the end of the line."""
    pattern = rf"{word}\s*(\d+)[.:]\s*([^\n]+)"
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), 1).alias("n"), F.regexp_extract_all(text, F.lit(pattern), 2).alias("c"))
    return df.select(key, F.posexplode(pairs).alias("ord", "x")).select(key, F.col("x.n").cast("int").alias("number"), "ord", strip(F.substring(F.col("x.c"), 1, longest)).alias("caption"))


def longest_caption(rows: DataFrame, key: str) -> DataFrame:
    """The longest caption of each number; the first of equally long ones."""
    return rows.groupBy(key, "number").agg(F.max_by("caption", F.struct(F.length("caption"), -F.col("ord"))).alias("caption"))


def metrics(df: DataFrame, key: str, text: str, most: int | None = None) -> DataFrame:
    """(key, kind, value, ord) of each stated figure, once per value and key in the order of METRICS; the first ``most``."""

    def of(n: int, kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(pattern), 0), lambda v, i: F.struct(F.lit(n).alias("k"), i.alias("i"), F.lit(kind).alias("kind"), v.alias("value")))

    found = F.concat(*[of(n, k, p) for n, (k, p) in enumerate(METRICS)])
    rows = df.select(key, F.explode(found).alias("m")).select(key, "m.k", "m.i", "m.kind", "m.value")
    once = rows.withColumn("__n", F.row_number().over(Window.partitionBy(key, "value").orderBy("k", "i"))).filter("__n = 1")
    placed = once.withColumn("ord", F.row_number().over(Window.partitionBy(key).orderBy("k", "i")))
    out = placed if most is None else placed.filter(F.col("ord") <= most)
    return out.select(key, "kind", "value", "ord")


def metric_contexts(df: DataFrame, key: str, text: str, around: int = 50) -> DataFrame:
    """(key, kind, value, context): each figure with the text around it, cut at blanks. Positions need Python."""
    import re
    from collections.abc import Iterator

    import pandas as pd

    kind = df.schema[key].dataType.simpleString()
    patterns = [(k, re.compile(p)) for k, p in METRICS]

    def context(t: str, m: re.Match) -> str:
        before, after = t[: m.start()][-around:], t[m.end() :][:around]
        # A word that the border of the window cuts is left out.
        if m.start() > around:
            before = before.partition(" ")[2]
        if len(t) - m.end() > around:
            after = after.rpartition(" ")[0]
        return f"{before}{m.group()}{after}".strip()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b["k"], b["t"]):
                seen = set()
                for name, p in patterns:
                    for m in p.finditer(t):
                        if m.group() not in seen:
                            seen.add(m.group())
                            rows.append((k, name, m.group(), context(t, m)))
            yield pd.DataFrame(rows, columns=[key, "kind", "value", "context"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).filter("t is not null").mapInPandas(run, f"`{key}` {kind}, kind string, value string, context string")


def timelines(df: DataFrame, key: str, text: str, longest: int = 100) -> DataFrame:
    """(key, label, milestone) of lines such as 'Q3 2024: first patient dosed'."""
    pair = lambda p: F.arrays_zip(F.regexp_extract_all(text, F.lit(p), 1).alias("a"), F.regexp_extract_all(text, F.lit(p), 2).alias("b"))
    return df.select(key, F.explode(F.concat(*map(pair, TIMELINES))).alias("x")).select(key, strip(F.col("x.a")).alias("label"), F.substring(strip(F.col("x.b")), 1, longest).alias("milestone"))


def action_items(df: DataFrame, key: str, line: str) -> DataFrame:
    """(key, action, owner, deadline) of lines over ten characters; '' where no owner or deadline is named."""
    bare = strip(F.col(line))
    return df.filter(F.length(bare) > 10).select(key, bare.alias("action"), F.regexp_extract(line, OWNER, 1).alias("owner"), F.regexp_extract(line, DEADLINE, 1).alias("deadline"))


def ids(c: Column, most: int = 20) -> Column:
    """Distinct compound codes of a text in order, the first ``most``."""
    return F.slice(F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(IDS), 0))), 1, most)
