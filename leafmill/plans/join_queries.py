"""Joins, matching and deduplication over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafmill.functions import text as X
from leafmill.operators import matching as M
from leafmill.operators import merging as G
from leafmill.plans.registry import quoted, query
from leafmill.session import table


@query(
    """WITH keyed AS (SELECT n_nationkey, n_name, n_regionkey, unnest([1, 2]) AS p FROM nation),
    named AS (SELECT n_nationkey, n_regionkey, p, CASE p WHEN 1 THEN n_nationkey::VARCHAR ELSE n_name END AS k FROM keyed),
    once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p, n_nationkey) AS r FROM named) WHERE r = 1)
    SELECT s_suppkey, o.n_regionkey FROM supplier s LEFT JOIN once o ON s.s_nationkey::VARCHAR = o.k"""
)
def j_lookup_priority(spark, d):
    left = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("k"))
    return M.lookup(left, table(spark, d, "nation"), "k", ["n_nationkey", "n_name"], ["n_regionkey"], F.col("n_nationkey")).select("s_suppkey", "n_regionkey")


_ALIASES = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in M.COMPANY_ALIASES.items())
_ALIAS_KEYS = list(M.COMPANY_ALIASES)


@query(f"WITH alias(a, b) AS (VALUES {_ALIASES}), names AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN ' ' || upper((SELECT list(a ORDER BY a) FROM alias)[(c_custkey % {len(_ALIAS_KEYS)} + 1)::INT]) || ' ' ELSE c_name END AS n FROM customer) SELECT c_custkey, coalesce(b, trim(n)) AS company FROM names LEFT JOIN alias ON lower(trim(n)) = a")
def j_alias_normalize(spark, d):
    keys = F.array(*map(F.lit, sorted(_ALIAS_KEYS)))
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), F.upper(F.element_at(keys, (F.col("c_custkey") % len(_ALIAS_KEYS) + 1).cast("int"))), F.lit(" "))).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", M.canonical_company(raw).alias("company"))


@query("SELECT p.paper_id, min(w.work_id) AS work_id FROM (SELECT paper_id, lower(title) AS t FROM paper_meta WHERE length(title) >= 10) p JOIN (SELECT min(work_id) AS work_id, lower(title) AS t FROM crossref_work WHERE length(title) >= 10 GROUP BY 2) w ON contains(p.t, w.t) OR contains(w.t, p.t) GROUP BY 1 HAVING count(*) = 1")
def j_title_contains_unique(spark, d):
    works = table(spark, d, "crossref_work").groupBy(F.lower("title").alias("title")).agg(F.min("work_id").alias("work_id"))
    return M.unique_containment(table(spark, d, "paper_meta"), works, "paper_id", "title", "work_id", "title")


@query(
    """WITH a AS (SELECT report_id, w, count(*) AS n FROM (SELECT report_id, unnest(string_split_regex(lower(title), '[^a-z0-9]+')) AS w FROM ci_report) WHERE length(w) > 3 GROUP BY 1, 2),
    b AS (SELECT DISTINCT p_partkey, w FROM (SELECT p_partkey, unnest(string_split_regex(lower(p_name || ' ' || p_type || ' response predicts signature role'), '[^a-z0-9]+')) AS w FROM part) WHERE length(w) > 3),
    s AS (SELECT report_id, p_partkey, sum(n)::BIGINT AS score FROM a JOIN b USING (w) GROUP BY 1, 2 HAVING sum(n) >= 2)
    SELECT report_id, p_partkey, score FROM (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY score DESC, p_partkey) AS r FROM s) WHERE r = 1"""
)
def j_keyword_argmax(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type", F.lit("response predicts signature role")).alias("words"))
    return M.best_by_words(table(spark, d, "ci_report"), part, "report_id", "title", "p_partkey", "words")


@query(
    """WITH a AS (SELECT paper_id, list_distinct(regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]{3,}')) AS ta FROM paper_meta), b AS (SELECT work_id, list_distinct(regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]{3,}')) AS tb FROM crossref_work),
    j AS (SELECT paper_id, work_id, len(list_intersect(ta, tb)) AS common, len(list_distinct(list_concat(ta, tb))) AS total FROM a, b) SELECT * FROM j WHERE total > 0 AND common >= 0.75 * total"""
)
def j_jaccard_inverted(spark, d):
    return M.similar_titles(table(spark, d, "paper_meta"), table(spark, d, "crossref_work"), "paper_id", "title", "work_id", "title", 0.75)


_BLOCKS = "SELECT file_id, page_num, regexp_replace(l, '^\\s+|\\s+$', '', 'g') AS line FROM (SELECT file_id, page_num, unnest(string_split(text, chr(10))) AS l FROM page_text)"
_FOOTERS = f"SELECT file_id, line, slides FROM (SELECT file_id, line, count(DISTINCT page_num) AS slides FROM ({_BLOCKS}) WHERE length(line) > 5 GROUP BY 1, 2) JOIN (SELECT file_id, count(DISTINCT page_num) AS n FROM ({_BLOCKS}) GROUP BY 1) USING (file_id) WHERE slides >= greatest(3, 0.15 * n)"


def _blocks(spark, d):
    bare = X.strip(F.col("l"))
    return table(spark, d, "page_text").select("file_id", "page_num", F.explode(F.split("text", "\n")).alias("l")).select("file_id", "page_num", bare.alias("line"))


@query(f"SELECT file_id, count(*) AS kept FROM ({_BLOCKS}) b WHERE NOT EXISTS (SELECT 1 FROM ({_FOOTERS}) f WHERE f.file_id = b.file_id AND f.line = b.line) GROUP BY 1")
def j_footer_anti(spark, d):
    blocks = _blocks(spark, d)
    return blocks.join(G.recurring(blocks, "file_id", "page_num", "line"), ["file_id", "line"], "left_anti").groupBy("file_id").agg(F.count("*").alias("kept"))


@query("SELECT count(*) AS n, min(result_id) AS first_id, max(result_id) AS last_id FROM extraction_result e WHERE NOT EXISTS (SELECT 1 FROM extraction_result s WHERE s.result_id = e.result_id AND s.processed_at < TIMESTAMPTZ '2023-06-01 00:00:00+00')")
def j_incremental_anti(spark, d):
    from leafmill.streaming.incremental import unseen

    runs = table(spark, d, "extraction_result")
    new = unseen(runs, runs.filter(F.col("processed_at") < F.lit("2023-06-01 00:00:00").cast("timestamp")), ["result_id"])
    return new.agg(F.count("*").alias("n"), F.min("result_id").alias("first_id"), F.max("result_id").alias("last_id"))


@query("SELECT file_id, count(*) AS n FROM extraction_result WHERE file_id IN (SELECT file_id FROM extraction_result WHERE processed_at >= TIMESTAMPTZ '2024-06-01 00:00:00+00') GROUP BY 1")
def j_thread_semi(spark, d):
    from leafmill.streaming.incremental import changed_groups

    runs = table(spark, d, "extraction_result")
    return changed_groups(runs, runs.filter(F.col("processed_at") < F.lit("2024-06-01 00:00:00").cast("timestamp")), "result_id", "file_id").groupBy("file_id").agg(F.count("*").alias("n"))


@query("SELECT f.file_id, coalesce(f.page_count, n::INT) AS page_count, coalesce(f.pdf_type, 'seen') AS pdf_type FROM pdf_class f LEFT JOIN (SELECT file_id, count(DISTINCT page_num) AS n FROM page_text GROUP BY 1) p USING (file_id)")
def j_patch_upsert(spark, d):
    files = table(spark, d, "pdf_class").select("file_id", "page_count", "pdf_type")
    counted = table(spark, d, "page_text").groupBy("file_id").agg(F.count_distinct("page_num").cast("int").alias("page_count"))
    patched = M.patch(counted.withColumn("pdf_type", F.lit("seen")).join(files.select("file_id"), "file_id", "right"), files, ["file_id"], ["page_count", "pdf_type"])
    return patched.select("file_id", "page_count", F.coalesce("pdf_type", F.lit("seen")).alias("pdf_type"))


@query(
    """WITH RECURSIVE node AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey >= 16 THEN o_orderkey // 4 END AS p FROM orders), t AS (SELECT k, k AS root, 0::BIGINT AS depth FROM node WHERE p IS NULL UNION ALL SELECT n.k, t.root, t.depth + 1 FROM node n JOIN t ON n.p = t.k) SELECT k, root, depth FROM t"""
)
def j_claim_tree_recursive(spark, d):
    k = F.col("o_orderkey")
    nodes = table(spark, d, "orders").select(k.alias("k"), F.when(k >= 16, F.floor(k / 4)).alias("p"))
    return M.trees(nodes, "k", "p").select("k", "root", F.col("depth").cast("bigint").alias("depth"))


@query("SELECT p_partkey, b.label FROM part JOIN (VALUES ('small', 1, 15), ('middle', 12, 30), ('large', 31, 50)) b(label, lo, hi) ON p_size BETWEEN b.lo AND b.hi")
def j_range_band(spark, d):
    bands = spark.createDataFrame([("small", 1, 15), ("middle", 12, 30), ("large", 31, 50)], "label string, lo int, hi int").withColumn("g", F.lit(1))
    return M.within_band(table(spark, d, "part").withColumn("g", F.lit(1)), bands, ["g"], "p_size", "lo", "hi", 8).select("p_partkey", "label")


@query("SELECT c.event_id, p.value AS last_value FROM (SELECT * FROM events WHERE event_type = 'click') c ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) p ON c.user_id = p.user_id AND c.ts >= p.ts")
def j_asof_change(spark, d):
    events = table(spark, d, "events")
    clicks = events.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = events.filter("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("last_value"))
    return M.as_of(clicks, bought, ["user_id"], "ts", "last_value").select("event_id", "last_value")


_TOK = "list_distinct(regexp_extract_all(lower(coalesce({}, '')), '[a-z0-9]{{3,}}'))"


@query(
    f"""WITH p AS (SELECT paper_id, first_author, title, nullif(lower(regexp_replace(regexp_extract(doi, {quoted(X.DOI)}, 0), '[).,;]+$', '')), '') AS d FROM paper_meta),
    w AS (SELECT work_id, title AS wt, list_filter(list_transform(authors, lambda a: a.family), lambda x: x IS NOT NULL) AS fam, lower(doi) AS d FROM crossref_work),
    j AS (SELECT paper_id, work_id, coalesce(length(first_author) > 0, false) AND coalesce(len(fam) > 0, false) AS named, list_filter(string_split_regex(lower(coalesce(first_author, '')), '[\\s\\-'']+'), lambda x: length(x) > 1) AS h,
      flatten(list_transform(coalesce(fam, []), lambda f: list_filter(string_split_regex(lower(f), '[\\s\\-'']+'), lambda x: length(x) > 1))) AS fp, {_TOK.format('title')} AS ta, {_TOK.format('wt')} AS tb, length(coalesce(title, '')) < 10 OR length(coalesce(wt, '')) < 10 AS short FROM p JOIN w USING (d))
    SELECT paper_id, work_id, CASE WHEN named THEN len(list_intersect(h, fp)) > 0 ELSE short OR len(ta) = 0 OR len(tb) = 0 OR len(list_intersect(ta, tb)) / greatest(len(list_distinct(list_concat(ta, tb))), 1) >= 0.5 END AS accepted FROM j"""
)
def j_identity_check(spark, d):
    papers = table(spark, d, "paper_meta").select("paper_id", "first_author", F.col("title").alias("pt"), F.lower(X.clean_doi(F.col("doi"))).alias("d"))
    works = table(spark, d, "crossref_work").select("work_id", F.col("title").alias("wt"), F.filter(F.transform("authors", lambda a: a["family"]), lambda f: f.isNotNull()).alias("fam"), F.lower("doi").alias("d"))
    return papers.join(works, "d").select("paper_id", "work_id", M.same_record(F.col("first_author"), F.col("fam"), F.col("pt"), F.col("wt")).alias("accepted"))


@query("SELECT i.page_id, i.number, c.caption FROM (SELECT page_id, unnest([1, 2, 3]) AS number FROM page_text) i JOIN (SELECT page_id, number, arg_max(caption, length(caption) * 1000 - ord) AS caption FROM (SELECT page_id, unnest(range(len(n))) AS ord, unnest(n)::INT AS number, trim(unnest(c)[1:500]) AS caption FROM (SELECT page_id, regexp_extract_all(text, '(?:Figure|Fig\\.?)\\s*(\\d+)[.:]\\s*([^\\n]+)', 1) AS n, regexp_extract_all(text, '(?:Figure|Fig\\.?)\\s*(\\d+)[.:]\\s*([^\\n]+)', 2) AS c FROM page_text)) GROUP BY 1, 2) c USING (page_id, number)")
def j_caption_by_number(spark, d):
    from leafmill.operators import generators as T

    pages = table(spark, d, "page_text")
    captions = T.longest_caption(T.captions(pages, "page_id", "text"), "page_id")
    return pages.select("page_id", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("number")).join(captions, ["page_id", "number"]).select("page_id", "number", "caption")


# ---- dedup


@query("SELECT count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT event_id, row_number() OVER (PARTITION BY lower(event_type), user_id, props ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def u_event_dedup(spark, d):
    rows = G.keep_first(table(spark, d, "events"), G.event_key(F.col("event_type"), F.col("user_id").cast("string"), F.col("props")), F.col("ts"), F.col("event_id"))
    return rows.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    """WITH deal AS (SELECT report_id, row_number() OVER (PARTITION BY g ORDER BY report_id, pos) AS ord, g, who, t, t[1:80] AS h FROM (SELECT report_id, unnest(range(len(deals))) AS pos, unnest(deals) AS x, coalesce(source, '?') AS g, array_to_string(list_sort(list_distinct(coalesce(unnest(deals).parties, []))), '|') AS who, lower(coalesce(unnest(deals).details, '')) AS t FROM ci_report WHERE len(deals) > 0)),
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, who, h, CASE WHEN t = '' THEN ord ELSE 0 END ORDER BY ord) AS r FROM deal) WHERE r = 1)
    SELECT g, count(*) AS kept FROM firsts b WHERE NOT (b.t <> '' AND EXISTS (SELECT 1 FROM firsts a WHERE a.g = b.g AND a.who = b.who AND a.ord < b.ord AND a.t <> '' AND (contains(a.t, b.h) OR contains(b.t, a.h)))) GROUP BY 1"""
)
def u_deal_dedup(spark, d):
    rows = table(spark, d, "ci_report").select("report_id", F.coalesce("source", F.lit("?")).alias("g"), F.posexplode("deals").alias("pos", "x")).select("report_id", "g", "pos", "x.parties", "x.details")
    rows = rows.withColumn("ord", F.row_number().over(Window.partitionBy("g").orderBy("report_id", "pos")))
    return G.deduplicate_deals(rows, "g", "ord", "parties", "details").groupBy("g").agg(F.count("*").alias("kept"))


@query("SELECT source, array_to_string(list(company ORDER BY first_at, pos), '; ') AS companies FROM (SELECT coalesce(source, '?') AS source, company, min(report_id) AS first_at, arg_min(pos, report_id * 1000 + pos) AS pos FROM (SELECT source, report_id, unnest(companies_mentioned) AS company, unnest(range(len(companies_mentioned))) AS pos FROM ci_report) GROUP BY 1, 2) GROUP BY 1")
def u_list_union(spark, d):
    rows = table(spark, d, "ci_report").select(F.coalesce("source", F.lit("?")).alias("source"), "report_id", "companies_mentioned")
    return G.union_in_order(rows, ["source"], "report_id", "companies_mentioned").select("source", F.array_join("companies_mentioned", "; ").alias("companies"))


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5(text)")
def u_md5_dedup(spark, d):
    return table(spark, d, "documents").groupBy(F.md5(F.col("text").cast("binary")).alias("m")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("m")


@query("SELECT page_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: upper(regexp_replace(x, '^\\s+|\\s+$', '', 'g')) NOT IN ('CLAIMS', 'RESULTS', 'METHODS', 'DISCUSSION')), chr(10)) AS text FROM page_text WHERE text IS NOT NULL")
def u_headers_filter(spark, d):
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.upper(X.strip(x)).isin("CLAIMS", "RESULTS", "METHODS", "DISCUSSION"))
    return table(spark, d, "page_text").filter("text is not null").select("page_id", F.array_join(kept, "\n").alias("text"))
