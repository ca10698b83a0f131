"""Deduplication and merging of partial records."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.matching import ASSET_CODE, canonical_company, first_by


def keep_first(df: DataFrame, keys: list[Column], *order: Column) -> DataFrame:
    """The first row of each key in the order; null keys are a key of their own."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def event_key(company: Column, asset: Column, event: Column) -> list[Column]:
    return [F.lower(F.coalesce(company, F.lit(""))), F.lower(F.coalesce(asset, F.lit(""))), F.substring(F.lower(F.coalesce(event, F.lit(""))), 1, 50)]


def deduplicate_deals(df: DataFrame, group: str, order: str, parties: str, details: str) -> DataFrame:
    """Deals without those that repeat an earlier one: the same set of parties, and the first 80 characters of either text
    contained in the other.

    Rows of one set of parties are grouped; inside a group an equal 80-character beginning decides first, so only the
    distinct beginnings are compared.
    """
    who = F.array_join(F.array_sort(F.array_distinct(F.coalesce(F.col(parties), F.array().cast("array<string>")))), "|")
    text = F.lower(F.coalesce(F.col(details), F.lit("")))
    rows = df.withColumn("__who", who).withColumn("__text", text).withColumn("__head", F.substring(text, 1, 80))
    firsts = keep_first(rows, [F.col(group), F.col("__who"), F.col("__head"), (F.col("__text") == "").cast("int") * F.col(order)], F.col(order))
    a = firsts.select(group, "__who", F.col(order).alias("o1"), F.col("__text").alias("t1"), F.col("__head").alias("h1"))
    repeats = (
        firsts.filter("__text <> ''")
        .alias("b")
        .join(a.alias("a"), [group, "__who"])
        .filter((F.col("o1") < F.col(order)) & (F.col("t1") != "") & (F.col("t1").contains(F.col("__head")) | F.col("__text").contains(F.col("h1"))))
        .select(group, order)
        .distinct()
    )
    return firsts.join(repeats, [group, order], "left_anti").drop("__who", "__text", "__head")


def union_in_order(df: DataFrame, keys: list[str], order: str, values: str) -> DataFrame:
    """(keys, values): distinct elements of the arrays of a group in order of first appearance."""
    each = df.select(*keys, order, F.posexplode(values).alias("pos", "v")).groupBy(*keys, "v").agg(F.min(F.struct(order, "pos")).alias("at"))
    return each.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias(values))


def merge_assets(assets: DataFrame) -> DataFrame:
    """Partial extractions of a document merged by company and asset.

    ``assets``: doc_id, ord, company, name, target, payload, stage, indications, clinical_data (arrays of strings), updates
    (array of structs text, indications). Scalars take the first filled value; lists keep the order of first appearance;
    updates of one text pool their indications; blank updates and rows without a name go.
    """
    rows = assets.withColumn("company", canonical_company(F.col("company"))).withColumn("key", F.lower(F.trim("name"))).filter("key <> ''")
    keys = ["doc_id", "company", "key"]
    first = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("ord"))).alias(c)
    scalars = rows.groupBy(*keys).agg(F.min_by("name", "ord").alias("name"), *map(first, ("target", "payload", "stage")))
    updates = rows.select(*keys, "ord", F.posexplode("updates").alias("pos", "u")).select(*keys, F.col("u.text").alias("text"), F.struct("ord", "pos").alias("at"), F.coalesce(F.col("u.indications"), F.array().cast("array<string>")).alias("ind")).filter("text <> ''")
    pooled = updates.groupBy(*keys, "text").agg(F.min("at").alias("at"), F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ind"))), lambda x: x["ind"]))).alias("indications"))
    updates = pooled.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text", "indications"))), lambda x: F.struct(x["text"].alias("text"), x["indications"].alias("indications"))).alias("updates"))
    out = scalars.join(union_in_order(rows, keys, "ord", "indications"), keys, "left").join(union_in_order(rows, keys, "ord", "clinical_data"), keys, "left").join(updates, keys, "left")
    return out.select("doc_id", "company", "name", "target", "payload", "stage", "indications", "clinical_data", "updates")


def resolve_asset_codes(assets: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``canonical``: a code-like name of five characters and more takes the longest name of its group that holds it.

    The longer name has a word that begins like the code, so candidates meet on the first five characters of their words.
    """
    low = F.lower(F.trim(F.col(name)))
    names = assets.select(*keys, low.alias("n")).distinct()
    codes = names.filter((F.length("n") >= 5) & F.col("n").rlike(ASSET_CODE)).select(*keys, F.col("n").alias("code"), F.substring("n", 1, 5).alias("head"))
    grams = names.select(*keys, F.col("n").alias("full"), F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("n") - 4, F.lit(1))), lambda i: F.substring(F.col("n"), i, F.lit(5)))).alias("head")).distinct()
    best = codes.join(grams, [*keys, "head"]).filter((F.length("full") > F.length("code")) & F.col("full").contains(F.col("code"))).groupBy(*keys, "code").agg(F.max_by("full", F.struct(F.length("full"), "full")).alias("canonical"))
    joined = assets.withColumn("code", low).join(best, [*keys, "code"], "left")
    return joined.withColumn("canonical", F.coalesce("canonical", "code")).drop("code")


def greedy_assets(assets: DataFrame) -> DataFrame:
    """Adds ``asset_no``: names matched one after another in arrival order, each to the first earlier one that it equals or,
    for codes, contains or is contained in. Order decides, so each document and company is worked through in Python."""
    import re

    code = re.compile(ASSET_CODE)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows, kept, numbers = rows.sort_values("ord", kind="stable"), [], []
        for name in rows["name"].fillna("").str.lower().str.strip():
            hit = next((i for i, k in enumerate(kept) if k == name or (lambda s, b: len(s) >= 5 and s in b and code.match(s))(*sorted((k, name), key=len))), None) if name else None
            if hit is None:
                kept.append(name)
                hit = len(kept) - 1
            numbers.append(hit)
        return rows.assign(asset_no=numbers)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in assets.schema.fields)
    return assets.groupBy("doc_id", "company").applyInPandas(run, f"{fields}, asset_no int")


def recurring(df: DataFrame, doc: str, slide: str, block: str, share: float = 0.15, least: int = 3) -> DataFrame:
    """(doc, block, slides) of blocks over five characters on at least ``least`` slides and ``share`` of them."""
    bare = F.regexp_replace(block, r"^\s+|\s+$", "")
    total = df.groupBy(doc).agg(F.count_distinct(slide).alias("n"))
    held = df.select(doc, slide, bare.alias(block)).filter(F.length(block) > 5).groupBy(doc, block).agg(F.count_distinct(slide).alias("slides"))
    return held.join(total, doc).filter(F.col("slides") >= F.greatest(F.lit(least), share * F.col("n"))).select(doc, block, "slides")


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    return first_by(df, keys, *order)

