"""Pages from word boxes, figure pages, figures in running text, attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def column_gap(words: DataFrame, keys: list[str], least: float = 10.0, share: float = 0.2) -> DataFrame:
    """(keys, split_at): the middle of the widest gap between word beginnings in the middle third of a page's width.

    ``words`` has x0, x1, top, word and page_width. A page has two columns where the gap is ``least`` points and more and
    each side holds ``share`` of the words.
    """
    starts = words.groupBy(*keys, "x0").agg(F.max("x1").alias("x1"), F.max("page_width").alias("page_width"))
    w = Window.partitionBy(*keys).orderBy("x0")
    ended = starts.withColumn("reach", F.max("x1").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    gaps = ended.withColumn("gap", F.col("x0") - F.col("reach")).filter((F.col("gap") >= least) & F.col("x0").between(F.col("page_width") / 3, 2 * F.col("page_width") / 3))
    widest = gaps.groupBy(*keys).agg(F.max_by((F.col("x0") + F.col("reach")) / 2, F.struct("gap", -F.col("x0"))).alias("split_at"))
    sides = words.join(widest, keys).groupBy(*keys, "split_at").agg(F.avg((F.col("x0") < F.col("split_at")).cast("double")).alias("left"))
    return sides.filter(F.col("left").between(share, 1 - share)).select(*keys, "split_at")


def page_text(words: DataFrame, keys: list[str], line_height: float = 4.0) -> DataFrame:
    """(keys, text): words in reading order, the left column before the right one; words within ``line_height`` share a line."""
    placed = words.join(column_gap(words, keys), keys, "left").withColumn("col", F.coalesce((F.col("x0") >= F.col("split_at")).cast("int"), F.lit(0))).withColumn("row", F.floor(F.col("top") / line_height))
    rows = placed.groupBy(*keys, "col", "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "word"))), lambda x: x["word"]), " ").alias("line"))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "row", "line"))), lambda x: x["line"]), "\n").alias("text"))


def figure_pages(pages: DataFrame, key: str, page_num: str, text: str, kind: Column, tables: Column, most: int) -> DataFrame:
    """The first ``most`` pages of each document with a figure: classed so, or short and headed by a caption; a page that
    holds tables and no figure is left out."""
    t = F.coalesce(F.col(text), F.lit(""))
    headed = F.substring(t, 1, 200).rlike(r"(?i)(figure|fig\.?|scheme)\s*\d+") & (F.length(t) < 500)
    rows = pages.filter(((kind == "FIGURE_PAGE") & ~tables) | headed)
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(page_num))).filter(F.col("__n") <= most).drop("__n")


def reversed_words(lines: Column, words: list[str]) -> Column:
    """Whether a page was read mirror-wise or in pieces: reversed words count 2, split subscripts 1, from 3 on it was."""
    back = [w[::-1] for w in words]
    return F.aggregate(lines, F.lit(0), lambda s, x: s + F.when(F.lower(x).rlike("|".join(back)), 2).otherwise(0) + F.when(x.rlike(r"^\s*[a-z]{1,2}\d?\s*$"), 1).otherwise(0)) >= 3


def with_figures(docs: DataFrame, figures: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): each figure block after the paragraph that first mentions it; the others at the end.

    ``figures`` has key, number and block.
    """
    paragraphs = docs.select(key, F.posexplode(F.split(text, "\n\n")).alias("pos", "p"))
    said = paragraphs.select(key, "pos", F.explode(F.array_distinct(F.regexp_extract_all("p", F.lit(r"(?i)fig(?:ure|\.)?\s*(\d+)"), 1))).alias("number"))
    first = said.groupBy(key, F.col("number").cast("int").alias("number")).agg(F.min("pos").alias("pos"))
    placed = figures.join(first, [key, "number"], "left").select(key, F.coalesce("pos", F.lit(2**30)).alias("pos"), F.lit(1).alias("k"), "number", F.col("block").alias("p"))
    parts = paragraphs.select(key, "pos", F.lit(0).alias("k"), F.lit(0).alias("number"), "p").unionByName(placed)
    return parts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "k", "number", "p"))), lambda x: x["p"]), "\n\n").alias(text))


def attachments(rows: DataFrame, thread: str, name: str, size: str, order: str, most_bytes: int = 15_000_000, logo_bytes: int = 15_000) -> DataFrame:
    """Attachments worth keeping with the name to file them under in ``stored_as``.

    Inline logos and files over the cap go; of one name and size in a thread the first stays; other files of one name get
    _1, _2 and so on in order of arrival.
    """
    low = F.lower(F.col(name))
    logo = low.rlike(r"\.(png|jpe?g|gif|bmp)$") & (low.rlike(r"^image\d+") | (F.col(size) < logo_bytes))
    kept = rows.filter(~F.coalesce(logo, F.lit(False)) & (F.col(size) <= most_bytes))
    once = kept.withColumn("__n", F.row_number().over(Window.partitionBy(thread, low, size).orderBy(order))).filter("__n = 1").drop("__n")
    nth = F.row_number().over(Window.partitionBy(thread, low).orderBy(order)) - 1
    stem, ext = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""), F.regexp_extract(name, r"(\.[A-Za-z0-9]+)$", 1)
    return once.withColumn("__i", nth).withColumn("stored_as", F.when(F.col("__i") == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), F.col("__i").cast("string"), ext))).drop("__i")


def route(name: Column) -> Column:
    """The pipeline of an attachment by its extension; null where none reads it."""
    ext = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(ext == "pdf", "pdf").when(ext.isin("pptx", "ppt"), "deck").when(ext.isin("docx", "doc"), "document").when(ext.isin("xlsx", "xls", "csv"), "sheet").when(ext.isin("png", "jpg", "jpeg", "gif"), "image")


def pdf_route(pages: Column, chars: Column, images: Column) -> Column:
    return F.when((pages <= 2) & (chars < 500) & (images > 0), "visual").when((pages == 1) & (chars < 2000), "visual").otherwise("paper")
