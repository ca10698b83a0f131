"""Scans, string and date functions, JSON and predicates over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import dates as D
from leafmill.functions import predicates as P
from leafmill.functions import text as X
from leafmill.plans.registry import quoted, query, sql_literal, sql_replace
from leafmill.session import table

STRIP = (r"^\s+|\s+$", "")
_digest = lambda c: (F.length(c).cast("bigint").alias("n"), F.md5(c.cast("binary")).alias("digest"))


def _sql_digest(e: str) -> str:
    return f"length({e}) AS n, md5({e}) AS digest"


# ---- scans


@query("SELECT coalesce(source, '?') AS source, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1")
def scan_documents(spark, d):
    return table(spark, d, "documents").groupBy(F.coalesce("source", F.lit("?")).alias("source")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT l_returnflag, count(*) AS n, sum(l_quantity)::BIGINT AS quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' AND l_quantity < 24 GROUP BY 1")
def scan_filter_pushdown(spark, d):
    rows = table(spark, d, "lineitem").filter((F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") < 24))
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("SELECT event_id, event_type, user_id FROM events ORDER BY ts, event_id LIMIT 500")
def scan_header_projection(spark, d):
    return table(spark, d, "events").select("event_id", "event_type", "user_id", "ts").orderBy("ts", "event_id").limit(500).drop("ts")


# ---- strings


@query(f"SELECT paper_id, {sql_replace('title', [(X.MARKDOWN_NOISE, ' ')])} AS title FROM paper_meta")
def x_markdown_strip(spark, d):
    return table(spark, d, "paper_meta").select("paper_id", X.strip_markdown(F.col("title")).alias("title"))


_TITLE = f"coalesce({sql_replace('title', [(X.MARKDOWN_NOISE, ' '), (chr(92) + 's+', ' '), STRIP])}, '')"


@query(f"SELECT paper_id, {_TITLE} AS title FROM paper_meta")
def x_title_sanitize(spark, d):
    return table(spark, d, "paper_meta").select("paper_id", X.sanitize_title(F.col("title")).alias("title"))


@query(f"SELECT paper_id, nullif(regexp_replace(regexp_extract(doi, {quoted(X.DOI)}, 0), '[).,;]+$', ''), '') AS doi FROM paper_meta")
def x_doi_clean(spark, d):
    return table(spark, d, "paper_meta").select("paper_id", X.clean_doi(F.col("doi")).alias("doi"))


@query("SELECT work_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(title), '[a-z0-9]{3,}'))), ' ') AS tokens FROM crossref_work")
def x_tokens(spark, d):
    return table(spark, d, "crossref_work").select("work_id", F.array_join(F.array_sort(X.tokens(F.col("title"))), " ").alias("tokens"))


_REPAIRED = sql_literal("text", X.MISREAD_WORDS)


@query(f"SELECT page_id, {_sql_digest('t')} FROM (SELECT page_id, {_REPAIRED} AS t FROM page_text WHERE text IS NOT NULL)")
def x_encoding_repair(spark, d):
    return table(spark, d, "page_text").filter("text is not null").select("page_id", X.repair_misread_words(F.col("text")).alias("t")).select("page_id", *_digest(F.col("t")))


@query(f"SELECT page_id, {_sql_digest('t')} FROM (SELECT page_id, {sql_replace('text', X.SPACING)} AS t FROM page_text WHERE text IS NOT NULL)")
def x_spacing_repair(spark, d):
    pages = table(spark, d, "page_text").filter("text is not null")
    return pages.select("page_id", X.repair_spacing(F.col("text")).alias("t")).select("page_id", *_digest(F.col("t")))


_CLEANED = sql_replace(sql_literal(sql_replace("text", [(X.PAGE_HEADER, ""), (X.MARGIN_NUMBER, "$2")]), X.MISREAD_WORDS), [*X.SPACING, (X.STRAY_LETTER, ""), (X.STRAY_SIGNS, ""), ("\\n{3,}", "\n\n"), STRIP])


@query(f"SELECT page_id, {_sql_digest('t')} FROM (SELECT page_id, {_CLEANED} AS t FROM page_text WHERE text IS NOT NULL)")
def x_text_clean_chain(spark, d):
    pages = table(spark, d, "page_text").filter("text is not null")
    return pages.select("page_id", X.clean_patent_text(F.col("text")).alias("t")).select("page_id", *_digest(F.col("t")))


@query(f"SELECT page_id, {_sql_digest('t')} FROM (SELECT page_id, {sql_replace('text', [*((p, '') for p in X.BOILERPLATE), (chr(92) + 'n{3,}', chr(10) * 2), STRIP])} AS t FROM page_text WHERE text IS NOT NULL)")
def x_boilerplate(spark, d):
    pages = table(spark, d, "page_text").filter("text is not null")
    return pages.select("page_id", X.strip_boilerplate(F.col("text")).alias("t")).select("page_id", *_digest(F.col("t")))


@query(f"SELECT part_key, {_sql_digest('t')} FROM (SELECT p_partkey AS part_key, {sql_replace(chr(39) + 'This poster template is ' + chr(39) + ' || p_type || ' + chr(39) + ' ratio. Kept ' + chr(39) + ' || p_name || ' + chr(39) + ' DO NOT POST now' + chr(39), [*((p, '') for p in X.TEMPLATE_LINES)])} AS t FROM part)")
def x_template_strip(spark, d):
    text = F.concat(F.lit("This poster template is "), "p_type", F.lit(" ratio. Kept "), "p_name", F.lit(" DO NOT POST now"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("part_key"), X.strip_template(text).alias("t")).select("part_key", *_digest(F.col("t")))


_HTML = "'<style>p {}</style><p class=\"x\"><b>' || p_brand || '</b> of <i>' || p_type || '</i>&nbsp;&amp; more<br/></p><ul><li>' || p_name || '</li></ul><a href=\"https://x.example/' || p_partkey || '\">go</a><div>end</div>'"


@query(f"SELECT part_key, {sql_replace(sql_literal(sql_replace('h', X.HTML_STEPS), X.ENTITIES), [(chr(92) + 'n{3,}', chr(10) * 2), ('[ ' + chr(9) + ']+', ' '), STRIP])} AS t FROM (SELECT p_partkey AS part_key, {_HTML} AS h FROM part)")
def x_html_to_text(spark, d):
    lit = F.lit
    html = F.concat(lit('<style>p {}</style><p class="x"><b>'), "p_brand", lit("</b> of <i>"), "p_type", lit("</i>&nbsp;&amp; more<br/></p><ul><li>"), "p_name", lit('</li></ul><a href="https://x.example/'), F.col("p_partkey").cast("string"), lit('">go</a><div>end</div>'))
    return table(spark, d, "part").select(F.col("p_partkey").alias("part_key"), X.html_to_text(html).alias("t"))


@query("SELECT o_orderkey, CASE WHEN s = '' THEN 'no_subject' ELSE lower(s) END AS subject FROM (SELECT o_orderkey, regexp_replace(regexp_replace(CASE o_orderkey % 4 WHEN 0 THEN 'Re: FW:  ' || o_orderpriority WHEN 1 THEN 'AW: ' WHEN 2 THEN 'wg:Re : ' || o_orderstatus ELSE o_orderpriority END, '(?i)^((re|fwd|fw|aw|wg|antwort|weitergeleitet)\\s*:\\s*)+', ''), '^\\s+|\\s+$', '', 'g') AS s FROM orders)")
def x_subject_norm(spark, d):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("Re: FW:  "), "o_orderpriority")).when(k == 1, F.lit("AW: ")).when(k == 2, F.concat(F.lit("wg:Re : "), "o_orderstatus")).otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", X.normalize_subject(raw).alias("subject"))


_STOP = ", ".join(map(quoted, X.SLUG_STOP))


@query(f"SELECT work_id, array_to_string(CASE WHEN len(k) > 0 THEN k[1:6] ELSE w[1:6] END, '_') AS slug FROM (SELECT work_id, w, list_filter(w, lambda x: lower(x) NOT IN ({_STOP})) AS k FROM (SELECT work_id, regexp_extract_all(title, '[A-Za-z0-9]+') AS w FROM crossref_work))")
def x_slug(spark, d):
    return table(spark, d, "crossref_work").select("work_id", X.title_slug(F.col("title")).alias("slug"))


@query(
    """SELECT o_orderkey, CASE WHEN b = '' THEN 'unnamed' WHEN regexp_matches(upper(regexp_extract(b, '^([^.]*)', 1)), '^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$') THEN '_' || b ELSE b END AS name
    FROM (SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(CASE o_orderkey % 3 WHEN 0 THEN 'con.txt' WHEN 1 THEN ' ..' || o_orderpriority || '/a:b?.pdf. ' ELSE '...' END, '[\\x00-\\x1f\\x7f]', '', 'g'), '[<>:"/\\\\|?*]', '_', 'g'), '^[. ]+|[. ]+$', '', 'g') AS b FROM orders)"""
)
def x_filename_sanitize(spark, d):
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.lit("con.txt")).when(k == 1, F.concat(F.lit(" .."), "o_orderpriority", F.lit("/a:b?.pdf. "))).otherwise(F.lit("..."))
    return table(spark, d, "orders").select("o_orderkey", X.safe_filename(raw).alias("name"))


@query(f"SELECT paper_id, replace(coalesce({sql_replace('title', [(chr(92) + 's+', ' '), STRIP])}, ''), '|', '\\|') AS cell FROM paper_meta")
def x_cell_escape(spark, d):
    return table(spark, d, "paper_meta").select("paper_id", X.escape_cell(F.col("title")).alias("cell"))


@query("SELECT paper_id, replace(replace(replace(title, '\\', '\\\\'), '\"', '\\\"'), chr(10), ' ') AS y FROM paper_meta")
def x_yaml_escape(spark, d):
    return table(spark, d, "paper_meta").select("paper_id", X.escape_yaml(F.col("title")).alias("y"))


@query("SELECT event_id, CASE WHEN regexp_matches(c, '^[=+\\-@]') THEN '''' || c ELSE c END AS c FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '=' WHEN 1 THEN '+' WHEN 2 THEN '-' WHEN 3 THEN '@' ELSE '' END || event_type AS c FROM events)")
def x_formula_guard(spark, d):
    k = F.col("event_id") % 5
    c = F.concat(F.when(k == 0, "=").when(k == 1, "+").when(k == 2, "-").when(k == 3, "@").otherwise(""), "event_type")
    return table(spark, d, "events").select("event_id", X.guard_formula(c).alias("c"))


@query("SELECT work_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/]+)', 1) AS host, regexp_extract(url, '://[^/]+(/.*)$', 1) AS path, regexp_extract(url, '://([^/]+)', 1) IN ('works.example') AS allowed FROM crossref_work WHERE url IS NOT NULL")
def x_url_parts(spark, d):
    u = F.col("url")
    return table(spark, d, "crossref_work").filter("url is not null").select("work_id", F.parse_url(u, F.lit("PROTOCOL")).alias("scheme"), F.parse_url(u, F.lit("HOST")).alias("host"), F.parse_url(u, F.lit("PATH")).alias("path"), P.allowed_host(u, ["works.example"]).alias("allowed"))


@query("SELECT work_id, regexp_replace(list_extract(string_split_regex(regexp_replace(authors[1].name, '^\\s+|\\s+$', '', 'g'), '\\s+'), -1), '[^\\p{L}\\-]', '', 'g') AS surname FROM crossref_work WHERE len(authors) > 0 AND authors[1].name IS NOT NULL")
def x_first_surname(spark, d):
    first = F.get("authors", F.lit(0))["name"]
    return table(spark, d, "crossref_work").filter(first.isNotNull()).select("work_id", X.surname(first).alias("surname"))


_F1, _F2, _F3 = (quoted(p) for p in (r"^(.+?) +et +al\. *[-–—] *(\d{4}) *[-–—] *(.+)$", r"^(.+?) *[-–—] *(\d{4}) *[-–—] *(.+)$", r"^(\S+) +(\d{4}) *[-–—] *(.+)$"))
_PICK = ", ".join(f"coalesce(nullif(regexp_extract(s, {_F1}, {g}), ''), nullif(regexp_extract(s, {_F2}, {g}), ''), nullif(regexp_extract(s, {_F3}, {g}), ''), '') AS {n}" for g, n in ((1, "author"), (2, "year"), (3, "title")))


@query(f"SELECT paper_id, {_PICK} FROM (SELECT paper_id, regexp_replace(file_name, '\\.[A-Za-z0-9]+$', '') AS s FROM paper_meta)")
def x_paper_filename(spark, d):
    author, year, title = X.paper_file(F.col("file_name"))
    return table(spark, d, "paper_meta").select("paper_id", author.alias("author"), year.alias("year"), title.alias("title"))


@query("SELECT page_id, 'WO' || regexp_extract(text, 'WO\\s*(\\d{4})/?(\\d+)\\s*([A-Z]\\d)?', 1) || regexp_extract(text, 'WO\\s*(\\d{4})/?(\\d+)\\s*([A-Z]\\d)?', 2) || coalesce(nullif(regexp_extract(text, 'WO\\s*(\\d{4})/?(\\d+)\\s*([A-Z]\\d)?', 3), ''), 'A1') AS number FROM page_text WHERE regexp_matches(text, 'WO\\s*(\\d{4})/?(\\d+)\\s*([A-Z]\\d)?')")
def x_patent_number(spark, d):
    return table(spark, d, "page_text").select("page_id", X.patent_number(F.col("text")).alias("number")).filter("number is not null")


@query("SELECT c_custkey, regexp_replace(regexp_replace('[' || c_name || '](https://urldefense.example/v3/x) and <https://urldefense.example/y> end', '\\[([^\\]]+)\\]\\(https?://urldefense[^)]+\\)', '\\1', 'g'), '<https?://urldefense[^>]+>', '', 'g') AS t FROM customer")
def x_wrapped_links(spark, d):
    text = F.concat(F.lit("["), "c_name", F.lit("](https://urldefense.example/v3/x) and <https://urldefense.example/y> end"))
    return table(spark, d, "customer").select("c_custkey", X.strip_wrapped_links(text).alias("t"))


# ---- dates


@query("SELECT o_orderkey, strftime(o_orderdate::DATE, '%Y-%m-%d') AS iso FROM orders")
def d_month_name_date(spark, d):
    printed = F.date_format("o_orderdate", "d MMMM yyyy")
    return table(spark, d, "orders").select("o_orderkey", D.long_date(printed).cast("string").alias("iso"))


@query("SELECT o_orderkey, strftime(date_trunc('quarter', o_orderdate)::DATE, '%Y-%m-%d') AS iso FROM orders")
def d_quarter_date(spark, d):
    name = F.concat(F.lit("Report-Q"), F.quarter("o_orderdate").cast("string"), F.lit("-"), F.year("o_orderdate").cast("string"), F.lit("-final"))
    return table(spark, d, "orders").select("o_orderkey", D.file_date(name).cast("string").alias("iso"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate::DATE, '%Y-%m-%d') WHEN 1 THEN strftime(date_trunc('month', o_orderdate)::DATE, '%Y-%m-%d') WHEN 2 THEN strftime(date_trunc('year', o_orderdate)::DATE, '%Y-%m-%d') ELSE '2307-01-01' END AS iso FROM orders")
def d_ymd_prefix(spark, d):
    k = F.col("o_orderkey") % 4
    name = F.when(k == 0, F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("x"))).when(k == 1, F.concat(F.lit("Deck "), F.date_format("o_orderdate", "MMMM yyyy"))).when(k == 2, F.concat(F.lit("Deck_"), F.date_format("o_orderdate", "yyyy"))).otherwise(F.lit("Deck_2307"))
    return table(spark, d, "orders").select("o_orderkey", D.file_date(name).cast("string").alias("iso"))


@query("SELECT count(*) AS n, count_if(indexed_at < TIMESTAMPTZ '2024-06-30 00:00:00+00' - INTERVAL 7 DAY) AS stale FROM crossref_work")
def d_ttl_filter(spark, d):
    stale = D.expired(F.col("indexed_at"), F.lit("2024-06-30 00:00:00").cast("timestamp"), 7)
    return table(spark, d, "crossref_work").agg(F.count("*").alias("n"), F.count_if(stale).alias("stale"))


# ---- JSON and records


@query("SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, len(json_keys(props))::BIGINT AS n_keys FROM events WHERE props IS NOT NULL")
def l_props_parse(spark, d):
    rows = table(spark, d, "events").filter("props is not null").withColumn("keys", F.json_object_keys("props"))
    return rows.select("event_id", F.get(F.map_values(F.from_json("props", "map<string,string>")), F.lit(0)).alias("first_value"), F.size("keys").cast("bigint").alias("n_keys"))


@query("SELECT event_id, regexp_extract(answer, '```json\\n([^`]*)\\n```', 1) = props AS same FROM (SELECT event_id, props, 'Here: ```json' || chr(10) || props || chr(10) || '``` done' AS answer FROM events WHERE props IS NOT NULL)")
def l_fenced_json(spark, d):
    answer = F.concat(F.lit("Here: ```json\n"), "props", F.lit("\n``` done"))
    body = F.regexp_extract(answer, "```json\\n([^`]*)\\n```", 1)
    return table(spark, d, "events").filter("props is not null").select("event_id", (body == F.col("props")).alias("same"))


@query(
    """SELECT work_id, lower(doi) AS doi, coalesce(title, '') AS title, coalesce(year, '') AS year,
    coalesce(array_to_string(list_transform(list_filter(authors, lambda a: coalesce(a.family, '') <> ''), lambda a: a.family), '; '), '') AS families,
    coalesce(list_filter(authors, lambda a: a.sequence = 'first')[1].name, '') AS first_author FROM crossref_work"""
)
def l_shape_record(spark, d):
    named = F.filter("authors", lambda a: F.coalesce(a["family"], F.lit("")) != "")
    first = F.get(F.filter("authors", lambda a: a["sequence"] == "first"), F.lit(0))["name"]
    return table(spark, d, "crossref_work").select("work_id", F.lower("doi").alias("doi"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("year", F.lit("")).alias("year"), F.coalesce(F.array_join(F.transform(named, lambda a: a["family"]), "; "), F.lit("")).alias("families"), F.coalesce(first, F.lit("")).alias("first_author"))


_COALESCED = ", ".join(f"coalesce(nullif(w.{c}, ''), nullif(p.{c}, ''), '') AS {c}" for c in ("title", "journal", "year", "volume", "pages"))


@query(f"SELECT p.paper_id, {_COALESCED}, w.work_id IS NOT NULL AS verified FROM (SELECT *, nullif(lower(regexp_replace(regexp_extract(doi, {quoted(X.DOI)}, 0), '[).,;]+$', '')), '') AS d FROM paper_meta) p LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(doi) ORDER BY work_id) AS k FROM crossref_work WHERE doi IS NOT NULL) WHERE k = 1) w ON lower(w.doi) = p.d")
def l_metadata_coalesce(spark, d):
    from leafmill.operators.matching import first_by

    papers = table(spark, d, "paper_meta").withColumn("d", F.lower(X.clean_doi(F.col("doi")))).alias("p")
    works = first_by(table(spark, d, "crossref_work").filter("doi is not null").withColumn("d", F.lower("doi")), ["d"], F.col("work_id")).alias("w")
    joined = papers.join(works, F.col("p.d") == F.col("w.d"), "left")
    fields = [F.coalesce(F.nullif(F.col(f"w.{c}"), F.lit("")), F.nullif(F.col(f"p.{c}"), F.lit("")), F.lit("")).alias(c) for c in ("title", "journal", "year", "volume", "pages")]
    return joined.select("p.paper_id", *fields, F.col("w.work_id").isNotNull().alias("verified"))


@query("SELECT file_id, k AS name, max(length(v))::BIGINT AS n, md5(arg_max(v, length(v) * 1000000 - result_id)) AS content FROM (SELECT file_id, result_id, unnest(map_keys(sections)) AS k, unnest(map_values(sections)) AS v FROM extraction_result WHERE sections IS NOT NULL) WHERE v IS NOT NULL GROUP BY 1, 2")
def l_sections_longest(spark, d):
    rows = table(spark, d, "extraction_result").select("file_id", "result_id", F.explode("sections").alias("name", "v")).filter("v is not null")
    return rows.groupBy("file_id", "name").agg(F.max(F.length("v")).cast("bigint").alias("n"), F.md5(F.max_by("v", F.length("v").cast("bigint") * 1000000 - F.col("result_id")).cast("binary")).alias("content"))


@query("SELECT file_id, list_extract(string_split(p, chr(10)), 1)::INT AS page, length(p)::BIGINT AS n FROM (SELECT file_id, unnest(string_split(t, '===PAGE ')[2:]) AS p FROM (SELECT file_id, string_agg('===PAGE ' || page_num || chr(10) || coalesce(text, ''), '' ORDER BY page_num, page_id) AS t FROM page_text GROUP BY 1))")
def l_page_markers(spark, d):
    block = F.concat(F.lit("===PAGE "), F.col("page_num").cast("string"), F.lit("\n"), F.coalesce("text", F.lit("")))
    joined = table(spark, d, "page_text").groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_num", "page_id", block.alias("b")))), lambda x: x["b"]), "").alias("t"))
    parts = joined.select("file_id", F.explode(F.slice(F.split("t", "===PAGE "), F.lit(2), F.greatest(F.size(F.split("t", "===PAGE ")) - 1, F.lit(1)))).alias("p"))
    return parts.select("file_id", F.get(F.split("p", "\n"), F.lit(0)).cast("int").alias("page"), F.length("p").cast("bigint").alias("n"))


# ---- predicates


def _with_page_counts(pages):
    """Pages with the number of pages of their file: counts are joined, so texts stay where they are. A null file counts as one."""
    counts = pages.groupBy("file_id").agg(F.count("*").alias("pages")).withColumnRenamed("file_id", "__f")
    return pages.join(counts, F.col("file_id").eqNullSafe(F.col("__f")), "left").drop("__f")


_PAGES = "SELECT p.*, count(*) OVER (PARTITION BY file_id) AS pages FROM page_text p"
_BARE = f"length({sql_replace('coalesce(text, ' + chr(39) * 2 + ')', [STRIP])})"


@query(f"SELECT page_id, CASE WHEN page_num = 0 THEN 'TITLE_PAGE' WHEN {_BARE} < 100 THEN 'FIGURE_PAGE' WHEN pos > 0 AND pos - 1 < 0.3 * length(text) THEN 'REFERENCES_PAGE' WHEN page_num >= pages - 2 AND contains(lower(coalesce(text, '')), 'supplementary') THEN 'SUPPLEMENTARY_PAGE' ELSE 'TEXT_PAGE' END AS class FROM (SELECT *, instr(text, nullif(regexp_extract(text, {quoted(P.REFERENCES_HEADER.replace('(?md)', '(?m)'))}, 0), '')) AS pos FROM ({_PAGES}))")
def f_page_class(spark, d):
    pages = _with_page_counts(table(spark, d, "page_text"))
    return pages.select("page_id", P.paper_page_class(F.col("text"), F.col("page_num"), F.col("pages")).alias("class"))


@query(f"SELECT page_id, CASE WHEN page_num = 0 THEN 'COVER' WHEN page_num >= pages - 10 AND regexp_matches(coalesce(text, ''), {quoted(P.SEARCH_REPORT)}) THEN 'SEARCH_REPORT' WHEN {_BARE} < 100 THEN 'FIGURE_PAGE' ELSE 'TEXT_HEAVY' END AS class FROM ({_PAGES})")
def f_patent_page_class(spark, d):
    pages = _with_page_counts(table(spark, d, "page_text"))
    return pages.select("page_id", P.patent_page_class(F.col("text"), F.col("page_num"), F.col("pages")).alias("class"))


@query("SELECT file_id, CASE WHEN n <= 3 AND file_id % 7 = 0 THEN 'poster' WHEN regexp_matches(upper(coalesce(head, '')[1:2000]), 'PCT/|WO \\d{4}/|PATENT') THEN 'patent' WHEN good = 0 AND n > 5 THEN 'talk' ELSE 'paper' END AS class FROM (SELECT file_id, count(*) AS n, arg_min(text, page_num * 1000000 + page_id) AS head, count_if(page_num < 5 AND length(coalesce(text, '')) > 100) AS good FROM page_text GROUP BY 1)")
def f_doc_router(spark, d):
    files = table(spark, d, "page_text").groupBy("file_id").agg(F.count("*").alias("n"), F.min_by("text", F.when(F.col("text").isNotNull(), F.col("page_num").cast("bigint") * 1000000 + F.col("page_id"))).alias("head"), F.count_if((F.col("page_num") < 5) & (F.length(F.coalesce("text", F.lit(""))) > 100)).alias("good"))
    widest = F.when(F.col("file_id") % 7 == 0, 3000).otherwise(600)
    return files.select("file_id", P.document_class(F.col("n"), widest, F.col("head"), F.col("good")).alias("class"))


_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '')"
_LETTERS = "length(regexp_replace(coalesce(text, ''), '[^\\p{L}]', '', 'g'))"


@query(f"SELECT page_id, {_BARE} >= 100 AND n >= 20 AND {_LETTERS} / greatest(length(coalesce(text, '')), 1)::DOUBLE >= 0.3 AND len(list_filter(w, lambda x: length(x) <= 2)) / greatest(n, 1)::DOUBLE <= 0.4 AND coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) / greatest(n, 1)::DOUBLE >= 3 AS readable FROM (SELECT *, len(w) AS n FROM (SELECT *, {_WORDS} AS w FROM page_text))")
def f_readable(spark, d):
    return table(spark, d, "page_text").select("page_id", P.readable(F.col("text")).alias("readable"))


@query(f"SELECT page_id, CASE WHEN n < 15 THEN 'figure' WHEN n > 100 AND n / m > 5 AND len(list_filter(l, lambda x: length(regexp_replace(x, '^\\s+|\\s+$', '', 'g')) > 40)) / m > 0.3 THEN 'text' WHEN n < 50 OR n / m < 3 THEN 'figure' ELSE 'text' END AS class FROM (SELECT *, len(w) AS n, greatest(len(l), 1)::DOUBLE AS m FROM (SELECT *, {_WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g') <> '') AS l FROM page_text))")
def f_ocr_text_class(spark, d):
    return table(spark, d, "page_text").select("page_id", P.ocr_page_class(F.col("text")).alias("class"))


@query(
    f"""SELECT report_id, ['public', 'confidential', 'secret'][coalesce(greatest(a, b), 1) + 1] AS label FROM (SELECT report_id,
    greatest(CASE WHEN regexp_matches(f, 'secret|strictly[ \\-]?confidential') THEN 2 END, CASE WHEN regexp_matches(f, 'confidential|restricted|internal use') THEN 1 END, CASE WHEN regexp_matches(f, 'public|non[ _-]?con') THEN 0 END) AS a,
    CASE WHEN regexp_matches(t, {quoted(P.SECRET_MARKS)}) THEN 2 WHEN regexp_matches(t, {quoted(P.CONFIDENTIAL_MARKS)}) THEN 1 WHEN regexp_matches(t, {quoted(P.PUBLIC_MARKS)}) THEN 0 END AS b
    FROM (SELECT report_id, lower(coalesce(file_name, '')) AS f, lower(coalesce(title, '')) || CASE report_id % 5 WHEN 0 THEN ' top secret' WHEN 1 THEN ' for public release' WHEN 2 THEN ' non-confidential' ELSE '' END AS t FROM ci_report))"""
)
def f_sensitivity_label(spark, d):
    k = F.col("report_id") % 5
    text = F.concat(F.coalesce("title", F.lit("")), F.when(k == 0, " top secret").when(k == 1, " for public release").when(k == 2, " non-confidential").otherwise(""))
    return table(spark, d, "ci_report").select("report_id", P.sensitivity(F.col("file_name"), text).alias("label"))


_COUNTS = ", ".join(f"len(list_filter(w, lambda x: x IN ({', '.join(map(quoted, v.split()))}))) AS {k}" for k, v in P.CONTENT_WORDS.items())
_CASES = " ".join(f"WHEN {k} = greatest({', '.join(P.CONTENT_WORDS)}) THEN '{k}'" for k in P.CONTENT_WORDS)


@query(f"SELECT doc_id, CASE WHEN greatest({', '.join(P.CONTENT_WORDS)}) < 2 THEN 'operational' {_CASES} END AS kind FROM (SELECT doc_id, {_COUNTS} FROM (SELECT doc_id, string_split_regex(regexp_replace(replace(lower(text), 'co-develop', 'codevelop'), 'p[ \\-]value', 'pvalue', 'g'), '[^a-z0-9]+') AS w FROM documents))")
def f_content_type(spark, d):
    return table(spark, d, "documents").select("doc_id", P.content_type(F.col("text")).alias("kind"))


_CLAIM = "CASE l_linenumber % 5 WHEN 0 THEN 'A compound of ' WHEN 1 THEN 'The method for ' WHEN 2 THEN 'Use of ' WHEN 3 THEN 'A pharmaceutical kit ' ELSE 'An item for use in ' END || l_returnflag"
_CLASSES = " ".join(f"WHEN regexp_matches(lower(c), {quoted(p)}) THEN '{n}'" for n, p in P.CLAIM_CLASSES)


@query(f"SELECT category, count(*) AS n FROM (SELECT CASE {_CLASSES} ELSE 'other' END AS category FROM (SELECT {_CLAIM} AS c FROM lineitem)) GROUP BY 1")
def f_claim_category(spark, d):
    k = F.col("l_linenumber") % 5
    c = F.concat(F.when(k == 0, "A compound of ").when(k == 1, "The method for ").when(k == 2, "Use of ").when(k == 3, "A pharmaceutical kit ").otherwise("An item for use in "), "l_returnflag")
    return table(spark, d, "lineitem").select(P.claim_class(c).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


_SMILE = "CASE p_size % 4 WHEN 0 THEN 'CC(=O)N[' || p_size || ']' WHEN 1 THEN 'CC(' || p_size WHEN 2 THEN 'C C' ELSE 'CO' END"


@query(f"SELECT p_partkey, length(s) >= 3 AND regexp_matches(s, {quoted(P.SMILES)}) AND length(replace(s, '(', '')) = length(replace(s, ')', '')) AND length(replace(s, '[', '')) = length(replace(s, ']', '')) AS valid FROM (SELECT p_partkey, {_SMILE} AS s FROM part)")
def f_smiles_valid(spark, d):
    k, size = F.col("p_size") % 4, F.col("p_size").cast("string")
    s = F.when(k == 0, F.concat(F.lit("CC(=O)N["), size, F.lit("]"))).when(k == 1, F.concat(F.lit("CC("), size)).when(k == 2, "C C").otherwise("CO")
    return table(spark, d, "part").select("p_partkey", P.smiles_valid(s).alias("valid"))


@query("SELECT page_id, len(full_cells) >= 0.4 * len(cells) AND len(list_filter(full_cells, lambda x: length(x) > 200)) <= 0.2 * len(full_cells) AS plausible FROM (SELECT page_id, cells, list_filter(cells, lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g') <> '') AS full_cells FROM (SELECT page_id, flatten(list_transform(string_split(text, chr(10)), lambda l: string_split(l, ' | '))) AS cells FROM page_text WHERE text IS NOT NULL))")
def f_plausible_table(spark, d):
    rows = F.transform(F.split("text", "\n"), lambda line: F.split(line, r" \| "))
    return table(spark, d, "page_text").filter("text is not null").select("page_id", P.plausible_table(rows).alias("plausible"))
