"""Operators over ordered rows: sections, runs, change logs, budgets and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Header lines of the sections of a paper.
PAPER_SECTIONS = {
    "abstract": "ABSTRACT|Abstract",
    "introduction": "INTRODUCTION|Introduction|BACKGROUND|Background",
    "methods": "METHODS?|MATERIALS? AND METHODS?|EXPERIMENTAL( PROCEDURES?)?|METHODOLOGY|STUDY DESIGN|Methods?|Materials? and Methods?|Online methods?",
    "results": "RESULTS?|FINDINGS|Results?",
    "discussion": "DISCUSSION|Discussion|INTERPRETATION",
    "conclusions": "CONCLUSIONS?|CONCLUDING REMARKS?|SUMMARY|Conclusions?|Summary",
    "references": "REFERENCES|BIBLIOGRAPHY|LITERATURE CITED|References|Bibliography",
    "acknowledgements": "ACKNOWLEDGEMENTS?|ACKNOWLEDGMENTS?|FUNDING|Acknowledgements?",
}


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line), line_no from 0; null texts give no rows."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def sections(df: DataFrame, key: str, text: str, headers: dict[str, str] = PAPER_SECTIONS, least: int = 50) -> DataFrame:
    """(key, name, start, content): each section from its first header line to the next header line of any section.

    Contents of ``least`` characters or fewer are left out. The headers of a text are found line by line, so one pass over
    the lines and one window per text do.
    """
    rows = lines(df, key, text).withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    name = F.lit(None).cast("string")
    for n, p in reversed(headers.items()):
        name = F.when(F.col("line").rlike(rf"^\s*(\d+\.?\s*)?({p})\s*$"), n).otherwise(name)
    found = rows.withColumn("name", name).filter("name is not null")
    once = found.withColumn("__n", F.row_number().over(Window.partitionBy(key, "name").orderBy("line_no"))).filter("__n = 1")
    ended = once.withColumn("end", F.lead("start").over(Window.partitionBy(key).orderBy("start")))
    cut = ended.join(df.select(key, F.col(text).alias("__t")), key)
    body = cut.withColumn("from", F.col("start") + F.length("line") + 1)
    content = F.regexp_replace(F.substring(F.col("__t"), F.col("from") + 1, F.coalesce(F.col("end"), F.length("__t")) - F.col("from")), r"^\s+|\s+$", "")
    return body.select(key, "name", "start", content.alias("content")).filter(F.length("content") > least)


def runs(df: DataFrame, keys: list[str], order: str, test: Column) -> DataFrame:
    """Adds ``in_run``, ``run_id`` and ``run_size``: neighbouring rows for which the test holds share a run."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("in_run", F.coalesce(test, F.lit(False)))
    islands = marked.withColumn("run_id", F.row_number().over(w) - F.row_number().over(Window.partitionBy(*keys, "in_run").orderBy(order)))
    return islands.withColumn("run_size", F.count("*").over(Window.partitionBy(*keys, "in_run", "run_id")))


def collapse_axis_numbers(df: DataFrame, key: str, order: str, line: str, least: int = 3) -> DataFrame:
    """Runs of ``least`` lines and more that hold only numbers become one line '[Chart axis: a, b, c]'; others stay."""
    bare = F.regexp_replace(line, r"^\s+|\s+$", "")
    test = bare.rlike(r"^[\d.,\s\-]+$") & (F.length(bare) < 20)
    r = runs(df.select(key, order, line), [key], order, test)
    drop = F.col("in_run") & (F.col("run_size") >= least)
    axis = r.filter(drop).groupBy(key, "run_id").agg(F.min(order).alias(order), F.concat(F.lit("[Chart axis: "), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, bare.alias("v")))), lambda x: x["v"]), ", "), F.lit("]")).alias(line))
    return r.filter(~drop).select(key, order, line).unionByName(axis.select(key, order, line))


def merge_fragments(df: DataFrame, key: str, order: str, line: str, longest: int = 35) -> DataFrame:
    """Neighbouring short lines that don't begin with [ or | are joined by blanks."""
    bare = F.regexp_replace(line, r"^\s+|\s+$", "")
    r = runs(df.select(key, order, line), [key], order, (F.length(bare) <= longest) & ~bare.rlike(r"^[\[|]"))
    joined = r.filter("in_run").groupBy(key, "run_id").agg(F.min(order).alias(order), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, bare.alias("v")))), lambda x: x["v"]), " ").alias(line))
    return r.filter("not in_run").select(key, order, line).unionByName(joined.select(key, order, line))


def change_log(df: DataFrame, keys: list[str], at: str, arrival: str, value: str) -> DataFrame:
    """(keys, at, old, new) wherever a value differs from the one before it; empty values are no observation.

    Ordered by time and then arrival, so late rows give the log that they would have given in time.
    """
    seen = df.filter(F.coalesce(F.col(value).cast("string"), F.lit("")) != "")
    w = Window.partitionBy(*keys).orderBy(at, arrival)
    return seen.withColumn("old", F.lag(value).over(w)).filter(F.col("old").isNotNull() & (F.col("old") != F.col(value))).select(*keys, at, "old", F.col(value).alias("new"))


def within_budget(df: DataFrame, keys: list[str], order: Column, size: Column, budget: int) -> DataFrame:
    """The leading rows of each group whose sizes sum to at most ``budget``."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("used", F.sum(size).over(w)).filter(F.col("used") <= budget)


def stride_sample(df: DataFrame, keys: list[str], order: Column, k: int) -> DataFrame:
    """At most ``k`` rows of each group, evenly over the order: those at int(i * n / k)."""
    n = F.count("*").over(Window.partitionBy(*keys))
    ranked = df.withColumn("__i", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1).withColumn("__n", n)
    picks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * F.col("__n") / k))
    return ranked.filter((F.col("__n") <= k) | F.array_contains(picks, F.col("__i").cast("long"))).drop("__i", "__n")


def top(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group with their place in ``rank``; Spark cuts groups before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)


def chunks(df: DataFrame, key: str, text: str, size: int = 12000, overlap: int = 500) -> DataFrame:
    """(key, chunk_no, chunk): whole paragraphs packed up to ``size`` characters, the trailing paragraphs of up to
    ``overlap`` characters carried over; a paragraph longer than ``size`` stays whole. Null and blank texts give none."""
    from collections.abc import Iterator

    import pandas as pd

    kind = df.schema[key].dataType.simpleString()

    def pack(paragraphs: list[str]) -> list[list[str]]:
        out, held, used = [], [], 0
        for p in paragraphs:
            if held and used + len(p) > size:
                out.append(held)
                carried, room = [], overlap
                for q in reversed(held):
                    if len(q) > room:
                        break
                    carried.insert(0, q)
                    room -= len(q)
                held, used = carried, overlap - room
            held = [*held, p]
            used += len(p)
        return [*out, held] if held else out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, "\n\n".join(c)) for k, t in zip(b["k"], b["t"]) for i, c in enumerate(pack([p for p in t.split("\n\n") if p.strip()]))]
            yield pd.DataFrame(rows, columns=[key, "chunk_no", "chunk"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).filter("t is not null").mapInPandas(run, f"`{key}` {kind}, chunk_no int, chunk string")
