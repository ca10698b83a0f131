"""Queries over the test tables, by problem: (spark, sf_dir) -> DataFrame, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import encodings, lookalikes, matching, mixing, names, packing, scans, splitting, survivors, tokens
from leafmill.session import materialize, table


def _spec(spark: SparkSession, sf_dir: str) -> dict[str, tuple[int, int]]:
    """size_spec is a fixed table of four rows."""
    return {r.spec_name: (r.capacity, r.overlap_size) for r in table(spark, sf_dir, "size_spec").collect()}


def p1_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired(table(spark, sf_dir, "page_text"), "page_id", "file_id", "page_num", "text", "needs_ocr")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = scans.repaired(table(spark, sf_dir, "page_text"), "page_id", "file_id", "page_num", "text", "needs_ocr", want_text=False)
    return judged.select("page_id", F.explode("defects").alias("defect")).distinct()


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "crossref_work").select(F.lit("author").alias("kind"), F.explode("authors.name").alias("name"))
    firms = table(spark, sf_dir, "ci_report").select(F.lit("company").alias("kind"), F.explode("companies_mentioned").alias("name"))
    return people.unionByName(firms)


def p2_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked(_mentions(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.linked_pairs(_mentions(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encodings.garbled(table(spark, sf_dir, "page_text"), "page_id", "text", "file_id")


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encodings.restored(table(spark, sf_dir, "page_text"), "page_id", "text", "file_id")


def p4_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.fuse(table(spark, sf_dir, "extraction_result")).select("file_id", "field", "result_id", "value", F.round("confidence", 6).alias("confidence"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "extraction_result")
    several = runs.groupBy("file_id").count().filter("count > 1").select("file_id")
    return survivors.fuse(runs).join(several, "file_id", "left_semi").select("file_id", "field", "result_id")


def p5_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = ("title", "year", "journal", "volume", "pages", "doi")
    papers = table(spark, sf_dir, "paper_meta").select(F.col("paper_id").alias("id"), F.when(F.size("authors") > 0, F.col("authors")).otherwise(F.array("first_author")).alias("names"), *shared)
    works = table(spark, sf_dir, "crossref_work").select(F.col("work_id").alias("id"), F.col("authors.name").alias("names"), *shared)
    return matching.match(papers, works).select(F.col("query").alias("paper_id"), F.col("record").alias("work_id"), F.round("confidence", 6).alias("confidence"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_matches(spark, sf_dir).select("paper_id", "work_id").distinct()


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacity, overlap = _spec(spark, sf_dir)["chunk"]
    return splitting.split_oversized(table(spark, sf_dir, "extraction_result"), "result_id", "text", capacity, overlap)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_pieces(spark, sf_dir).filter("n_pieces > 1").select("result_id").distinct()


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = [(n, c, o) for n, (c, o) in sorted(_spec(spark, sf_dir).items()) if n.startswith("pack")]
    sized = tokens.with_tokens(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    packed = packing.pack(packing.cut_items(sized, "doc_id", specs))
    return packed.select("spec_name", "container_id", F.col("item").alias("doc_id"), "piece_no", "start_at", "size", "capacity")


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill(p7_containers(spark, sf_dir))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialize(tokens.with_tokens(docs, "text", ["doc_id", "source"]), "sized")
    return mixing.mix(sized, table(spark, sf_dir, "mix_target"), "doc_id")


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(materialize(_mixed(spark, sf_dir), "mixed"), table(spark, sf_dir, "mix_target"))


def p9_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.consistent_forms(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.form_classes(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.alike(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_paragraphs, p1_found, p2_clusters, p2_found, p3_found, p3_restored, p4_survivors, p4_found, p5_matches, p5_found, p6_pieces, p6_found, p7_containers, p7_fill, p8_mix, p8_shares, p9_forms, p9_classes, p9_found)}
