"""Everything usable from spark.sql: functions, generators and the mail source."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from leafmill.functions import lines as L
from leafmill.functions import text as X
from leafmill.sources import files

#: Functions that are one expression become SQL functions, so that queries with them stay in the JVM.
_EXPRESSIONS = {
    "lm_strip_markdown": ("t STRING", "STRING", f"regexp_replace(t, r'{X.MARKDOWN_NOISE}', ' ')"),
    "lm_clean_doi": ("t STRING", "STRING", f"nullif(regexp_replace(regexp_extract(t, r'{X.DOI}', 0), r'[).,;]+$', ''), '')"),
    "lm_tokens": ("t STRING", "ARRAY<STRING>", f"array_distinct(regexp_extract_all(lower(coalesce(t, '')), '{X.TOKEN}', 0))"),
    "lm_jaccard": ("a ARRAY<STRING>, b ARRAY<STRING>", "DOUBLE", "size(array_intersect(a, b)) / greatest(size(array_union(a, b)), 1)"),
    "lm_grade": ("s DOUBLE", "STRING", "CASE WHEN s >= 8.0 THEN 'Excellent' WHEN s >= 5.5 THEN 'Good' WHEN s >= 4.0 THEN 'Fair' ELSE 'Poor' END"),
}


class Paragraphs:
    """SELECT * FROM lm_paragraphs(text)"""

    def eval(self, text: str):
        for i, p in enumerate(p for p in (text or "").split("\n\n") if p.strip()):
            yield i, p


def register(spark: SparkSession) -> list[str]:
    """Registers all functions in the session; returns their names."""
    for name, (args, kind, body) in _EXPRESSIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    columns = {"lm_fold": (L.fold, "string"), "lm_cut_quoted": (L.cut_quoted, "string"), "lm_model_json": (L.model_json, "string"), "lm_first_page_title": (L.first_page_title, "string"), "lm_person_slug": (L.person_slug, "string"), "lm_nfkc": (L.compatible, "string"), "lm_ratio": (L.ratio, "double")}
    for name, (f, kind) in columns.items():
        spark.udf.register(name, L.column(f, kind))
    spark.udtf.register("lm_paragraphs", udtf(Paragraphs, returnType="ord int, paragraph string"))
    files.register(spark)
    return [*_EXPRESSIONS, *columns, "lm_paragraphs"]

