"""Posters and talks matched to the rows of a programme."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.lines import column, ratio
from leafmill.functions.names import poster_number
from leafmill.operators.matching import first_by, unique_containment


def to_programme(posters: DataFrame, programme: DataFrame, path: str, title: str, number: str, programme_title: str, least: float = 0.75) -> DataFrame:
    """(path, number, how): by number in the file name, else by a title that alone contains the other, else by the most
    alike title of at least ``least``.

    Only posters that a step leaves over go on to the next. Alike titles share words: candidates come from a join on the
    words longer than three letters, and the costly ratio is taken for those pairs only.
    """
    rows = programme.select(F.upper(F.col(number).cast("string")).alias("number"), F.col(programme_title).alias("pt")).filter("number is not null").dropDuplicates(["number"])
    named = posters.select(F.col(path).alias("path"), F.col(title).alias("t"), poster_number(F.col(path)).alias("number"))
    by_number = named.join(rows.select("number"), "number", "left_semi").select("path", "number", F.lit("number").alias("how"))
    left = named.join(by_number.select("path"), "path", "left_anti")
    by_part = unique_containment(left, rows, "path", "t", "number", "pt").withColumn("how", F.lit("title"))
    left = left.join(by_part.select("path"), "path", "left_anti").filter(F.length("t") >= 10)
    words = lambda c: F.explode(F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: F.length(w) > 3)))
    near = left.select("path", "t", words("t").alias("w")).join(rows.select("number", "pt", words("pt").alias("w")), "w").select("path", "t", "number", "pt").distinct()
    scored = near.withColumn("r", column(ratio, "double")(F.col("t"), F.col("pt"))).filter(F.col("r") >= least)
    by_likeness = first_by(scored, ["path"], F.desc("r"), F.col("number")).select("path", "number", F.lit("likeness").alias("how"))
    return by_number.unionByName(by_part).unionByName(by_likeness)


def talks_to_abstracts(talks: DataFrame, abstracts: DataFrame, talk: str, surname: str, title: str, abstract: str, authors: str, abstract_title: str) -> DataFrame:
    """(talk, abstract, score): among the abstracts that name the speaker, the one that holds most words of the title."""
    named = abstracts.select(F.col(abstract).alias("abstract"), F.regexp_replace(F.col(abstract_title), "<[^>]+>", " ").alias("at"), F.explode(F.array_distinct(F.split(F.lower(F.col(authors)), r"[^\p{L}\-]+"))).alias("s"))
    by_name = talks.select(F.col(talk).alias("talk"), F.col(title).alias("t"), F.lower(F.col(surname)).alias("s")).filter("s <> ''").join(named, "s")
    words = F.filter(F.split(F.lower("t"), r"[^\p{L}\p{N}]+"), lambda w: F.length(w) > 3)
    scored = by_name.withColumn("score", F.aggregate(words, F.lit(0), lambda n, w: n + F.lower(F.col("at")).contains(w).cast("int")))
    return first_by(scored.filter("score >= 2"), ["talk"], F.desc("score"), F.col("abstract")).select("talk", "abstract", "score")
