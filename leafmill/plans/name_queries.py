"""Names of files and people, attachments, completeness and candidates over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafmill.functions import names as N
from leafmill.functions import scoring as Q
from leafmill.functions import text as X
from leafmill.operators import layout as Y
from leafmill.plans.registry import quoted, query
from leafmill.session import table

_SLUG = "(SELECT *, lower(array_to_string(CASE WHEN len(k) > 0 THEN k[1:6] ELSE w[1:6] END, '_')) AS slug FROM (SELECT *, list_filter(w, lambda x: lower(x) NOT IN (" + ", ".join(map(quoted, X.SLUG_STOP)) + ")) AS k FROM (SELECT *, regexp_extract_all(coalesce(title, ''), '[A-Za-z0-9]+') AS w FROM {})))"


def _part(expression: str, missing: str = "unknown") -> str:
    return f"regexp_replace(coalesce(nullif({expression}, ''), '{missing}'), '[\\s/]+', '_', 'g')"


@query(f"SELECT paper_id, {_part('first_author')} || '_' || {_part('year')} || '_' || {_part('slug')} || '.md' AS name FROM {_SLUG.format('paper_meta')}")
def x_output_name(spark, d):
    return table(spark, d, "paper_meta").select("paper_id", N.output_name("paper", "default", F.col("title"), first_author=F.col("first_author"), year=F.col("year")).alias("name"))


@query(f"SELECT report_id, regexp_replace(regexp_replace({_part('doc_type')} || '_' || {_part(chr(115) + 'trftime(report_date, ' + chr(39) + '%Y-%m-%d' + chr(39) + ')', 'undated')} || '_' || {_part('slug')} || '.md', '[<>:\"/\\\\|?*]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g') AS name FROM {_SLUG.format('ci_report')}")
def x_report_name(spark, d):
    return table(spark, d, "ci_report").select("report_id", N.output_name("report", "default", F.col("title"), kind=F.col("doc_type"), date=F.col("report_date")).alias("name"))


@query("SELECT p_partkey, upper(coalesce(nullif(regexp_extract(s, '(?i)^([A-Z]{0,4}\\d{2,}[A-Z]*)', 1), ''), nullif(regexp_extract(s, '\\s+-\\s+(\\d+)$', 1), ''), '')) AS number FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'lb' || p_partkey WHEN 1 THEN p_name || ' - ' || p_partkey ELSE p_name END AS s FROM part)")
def x_poster_number(spark, d):
    k, key = F.col("p_partkey") % 3, F.col("p_partkey").cast("string")
    name = F.concat(F.when(k == 0, F.concat(F.lit("lb"), key)).when(k == 1, F.concat("p_name", F.lit(" - "), key)).otherwise(F.col("p_name")), F.lit(".pdf"))
    return table(spark, d, "part").select("p_partkey", N.poster_number(name).alias("number"))


@query("SELECT o_orderkey, o_orderkey::VARCHAR AS \"order\", o_orderstatus AS session, 'C.' || o_orderstatus || 'unne' AS speaker, o_orderstatus || 'unne' AS surname, 'Toward ' || o_orderpriority AS title FROM orders")
def x_talk_parts(spark, d):
    name = F.concat_ws("_", F.col("o_orderkey").cast("string"), "o_orderstatus", F.concat(F.lit("C."), "o_orderstatus", F.lit("unne")), F.concat(F.lit("Toward_"), "o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(k) for k, c in N.talk_parts(F.concat(name, F.lit(".pdf"))).items()])


@query("SELECT file_name, CASE WHEN regexp_matches(file_name, '(?i)^conference') THEN 'conference' WHEN regexp_matches(file_name, '(?i)weekly|digest') THEN 'newsletter' WHEN regexp_matches(file_name, '20\\d{6}') THEN 'dated' ELSE 'other' END AS kind FROM ci_report")
def f_document_type(spark, d):
    patterns = [("conference", "(?i)^conference"), ("newsletter", "(?i)weekly|digest"), ("dated", r"20\d{6}")]
    return table(spark, d, "ci_report").select("file_name", N.document_type(F.col("file_name"), patterns).alias("kind"))


@query("SELECT c_custkey, slug || CASE WHEN r > 1 THEN '_' || r ELSE '' END AS slug FROM (SELECT c_custkey, lower(c_mktsegment) || '_' || c_nationkey AS slug, dense_rank() OVER (PARTITION BY lower(c_mktsegment) || '_' || c_nationkey ORDER BY c_custkey) AS r FROM customer)")
def j_slug_collision(spark, d):
    slugs = table(spark, d, "customer").select("c_custkey", F.concat_ws("_", F.lower("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("slug"))
    r = F.dense_rank().over(Window.partitionBy("slug").orderBy("c_custkey"))
    return slugs.withColumn("r", r).select("c_custkey", F.concat("slug", F.when(F.col("r") > 1, F.concat(F.lit("_"), F.col("r").cast("string"))).otherwise("")).alias("slug"))


_FILES = "SELECT o_custkey AS thread, o_orderkey AS i, CASE o_orderkey % 4 WHEN 0 THEN 'image001.png' WHEN 1 THEN 'Plan.pdf' WHEN 2 THEN 'plan.pdf' ELSE 'photo.jpg' END AS name, (o_totalprice / 10)::BIGINT * 100 AS size FROM orders"


@query(
    f"""WITH k AS (SELECT * FROM ({_FILES}) WHERE NOT (regexp_matches(lower(name), '\\.(png|jpe?g|gif|bmp)$') AND (regexp_matches(lower(name), '^image\\d+') OR size < 15000)) AND size <= 1500000),
    o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY thread, lower(name), size ORDER BY i) AS r FROM k) WHERE r = 1)
    SELECT thread, i, CASE WHEN n = 0 THEN name ELSE regexp_replace(name, '\\.[A-Za-z0-9]+$', '') || '_' || n || regexp_extract(name, '(\\.[A-Za-z0-9]+)$', 1) END AS stored_as FROM (SELECT *, row_number() OVER (PARTITION BY thread, lower(name) ORDER BY i) - 1 AS n FROM o)"""
)
def k_attachment_names(spark, d):
    k = F.col("o_orderkey") % 4
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("thread"), F.col("o_orderkey").alias("i"), F.when(k == 0, "image001.png").when(k == 1, "Plan.pdf").when(k == 2, "plan.pdf").otherwise("photo.jpg").alias("name"), (F.rint(F.col("o_totalprice") / 10).cast("bigint") * 100).alias("size"))
    return Y.attachments(rows, "thread", "name", "size", "i", 1_500_000).select("thread", "i", "stored_as")


@query("SELECT file_name, CASE WHEN regexp_matches(lower(file_name), '\\.pdf$') THEN 'pdf' WHEN regexp_matches(lower(file_name), '\\.pptx?$') THEN 'deck' WHEN regexp_matches(lower(file_name), '\\.docx?$') THEN 'document' WHEN regexp_matches(lower(file_name), '\\.(xlsx?|csv)$') THEN 'sheet' WHEN regexp_matches(lower(file_name), '\\.(png|jpe?g|gif)$') THEN 'image' END AS route FROM pdf_class")
def f_attachment_route(spark, d):
    return table(spark, d, "pdf_class").select("file_name", Y.route(F.col("file_name")).alias("route"))


@query("SELECT file_id, CASE WHEN n <= 2 AND chars < 500 AND ocr > 0 THEN 'visual' WHEN n = 1 AND chars < 2000 THEN 'visual' ELSE 'paper' END AS route FROM (SELECT file_id, count(*) AS n, sum(length(coalesce(text, ''))) AS chars, count_if(needs_ocr) AS ocr FROM page_text GROUP BY 1)")
def f_pdf_route(spark, d):
    files = table(spark, d, "page_text").groupBy("file_id").agg(F.count("*").alias("n"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars"), F.count_if("needs_ocr").alias("ocr"))
    return files.select("file_id", Y.pdf_route(F.col("n"), F.col("chars"), F.col("ocr")).alias("route"))


_FIELDS = ("title", "journal", "doi", "year", "volume", "pages")


@query(f"SELECT coalesce(extraction_method, '?') AS method, count(*) AS n, floor(sum({' + '.join(f'(coalesce(metadata.{f}, {chr(39) * 2}) <> {chr(39) * 2})::INT' for f in _FIELDS)}) * 10000 / (6 * count(*)))::BIGINT AS completeness FROM extraction_result GROUP BY 1")
def a_completeness(spark, d):
    present = sum((Q.filled(F.col(f"metadata.{f}")).cast("int") for f in _FIELDS), F.lit(0))
    rows = table(spark, d, "extraction_result").groupBy(F.coalesce("extraction_method", F.lit("?")).alias("method")).agg(F.count("*").alias("n"), F.sum(present).alias("s"))
    return rows.select("method", "n", F.floor(F.col("s") * 10000 / (6 * F.col("n"))).cast("bigint").alias("completeness"))


@query("SELECT file_id, page_id, rank FROM (SELECT file_id, page_id, row_number() OVER (PARTITION BY file_id ORDER BY length(coalesce(text, '')), page_num, page_id)::INT AS rank FROM page_text WHERE needs_ocr AND NOT regexp_matches(regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g'), '(?i)^(thank you|questions)')) WHERE rank <= 45")
def f_enrichment_candidates(spark, d):
    from leafmill.operators.sequences import top

    rows = table(spark, d, "page_text").filter(F.col("needs_ocr") & ~X.strip(F.coalesce("text", F.lit(""))).rlike("(?i)^(thank you|questions)"))
    return top(rows, ["file_id"], 45, F.length(F.coalesce("text", F.lit(""))), F.col("page_num"), F.col("page_id")).select("file_id", "page_id", "rank")


@query("SELECT page_id, regexp_extract(text, '(19[89]\\d|20[012]\\d)', 1) AS year, regexp_extract(text, '[A-H]\\d{2}[A-Z]\\d+/\\d+', 0) AS ipc, regexp_extract(text, 'PCT/([A-Z]{2}\\d{4}/\\d+)', 1) AS pct FROM page_text WHERE text IS NOT NULL")
def x_text_metadata(spark, d):
    t = F.col("text")
    return table(spark, d, "page_text").filter("text is not null").select("page_id", F.regexp_extract(t, X.YEAR, 1).alias("year"), F.regexp_extract(t, r"[A-H]\d{2}[A-Z]\d+/\d+", 0).alias("ipc"), F.regexp_extract(t, r"PCT/([A-Z]{2}\d{4}/\d+)", 1).alias("pct"))


@query()
def x_section_between(spark, d):
    return table(spark, d, "page_text").select("page_id", X.between_headers(F.col("text"), ["methods", "results"], ["discussion", "claims", "references", "results"]).alias("section")).filter("section <> ''")


@query()
def x_first_page(spark, d):
    from leafmill.functions import lines as L

    t = F.col("text")
    first = table(spark, d, "page_text").filter("page_num = 0 and text is not null")
    return first.select("page_id", L.column(L.first_page_title, "string")(t).alias("title"), F.array_join(L.column(L.first_page_authors, "array<string>")(t), "; ").alias("authors"), F.length(L.column(L.first_page_abstract, "string")(t)).alias("abstract_length"))
