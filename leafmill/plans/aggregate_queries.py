"""Quality scores, aggregates and merges over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import predicates as P
from leafmill.functions import scoring as Q
from leafmill.functions import text as X
from leafmill.operators import merging as G
from leafmill.plans.registry import quoted, query
from leafmill.session import table

_W = "list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '')"
_SIGNS = quoted(Q.GARBLED_SIGNS)


def _quality_sql(source: str, key: str) -> str:
    """(key, q) with the page quality of ``text``."""
    return f"""SELECT {key}, CASE WHEN length(t) < 50 OR n < 5 THEN 0.0 ELSE greatest(0.0, least(1.0, 0.20 * merged + 0.25 * average + 0.15 * lengthy + 0.15 * garbled + 0.10 * alpha + 0.15 * tiny)) END AS q FROM (SELECT {key}, t, n,
    greatest(0.0, 1 - 5 * len(regexp_extract_all(t, '[a-z][A-Z]')) / m::DOUBLE) AS merged,
    CASE WHEN avg_len <= 7 THEN 1.0 WHEN avg_len <= 9 THEN 1 - 0.2 * (avg_len - 7) ELSE greatest(0.0, 0.6 - (avg_len - 9) / 10) END AS average,
    greatest(0.0, 1 - 10 * len(list_filter(tested, lambda x: length(x) > 20)) / greatest(len(tested), 1)::DOUBLE) AS lengthy,
    greatest(0.0, 1 - 50 * (length(t) - length(translate(t, {_SIGNS}, ''))) / chars) AS garbled,
    least(1.0, length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) / chars / 0.6) AS alpha,
    greatest(0.0, 1 - 2.5 * len(list_filter(w, lambda x: length(x) <= 2)) / m::DOUBLE) AS tiny
    FROM (SELECT *, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) / m::DOUBLE AS avg_len, list_filter(w, lambda x: length(x) > 2 AND regexp_matches(x, '^\\p{{L}}')) AS tested, greatest(length(t), 1)::DOUBLE AS chars FROM (SELECT *, len(w) AS n, greatest(len(w), 1) AS m FROM (SELECT *, {_W} AS w FROM (SELECT *, coalesce(text, '') AS t FROM {source})))))"""


_SCALED = "floor({} * 10000 + 0.5)::BIGINT"


@query(f"SELECT page_id, {_SCALED.format('q')} AS quality FROM ({_quality_sql('page_text', 'page_id')})")
def a_page_quality(spark, d):
    return table(spark, d, "page_text").select("page_id", Q.scaled(Q.page_quality(F.col("text"))).alias("quality"))


@query(f"SELECT lang, source, count(*) AS n, sum({_SCALED.format('q')})::BIGINT AS quality, count_if(q >= 0.65) AS good FROM (SELECT coalesce(lang, '?') AS lang, coalesce(source, '?') AS source, q FROM documents JOIN ({_quality_sql('documents', 'doc_id')}) USING (doc_id)) GROUP BY 1, 2")
def page_quality_by_lang(spark, d):
    q = Q.page_quality(F.col("text"))
    scored = table(spark, d, "documents").select(F.coalesce("lang", F.lit("?")).alias("lang"), F.coalesce("source", F.lit("?")).alias("source"), q.alias("q"))
    return scored.groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum(Q.scaled(F.col("q"))).alias("quality"), F.count_if(F.col("q") >= 0.65).alias("good"))


@query(
    f"""WITH s AS (SELECT p.page_id, p.file_id, q, CASE WHEN q >= 0.65 THEN 'none' WHEN q < 0.30 THEN 'reclassify' ELSE 're-extract' END AS action FROM page_text p JOIN ({_quality_sql('page_text', 'page_id')}) USING (page_id))
    SELECT page_id, CASE WHEN action = 're-extract' AND row_number() OVER (PARTITION BY file_id, action ORDER BY floor(q * 10000 + 0.5), page_id) > 30 THEN 'over budget' ELSE action END AS action FROM s"""
)
def a_remediation(spark, d):
    from pyspark.sql import Window

    q = Q.page_quality(F.col("text"))
    rows = table(spark, d, "page_text").select("page_id", "file_id", Q.scaled(q).alias("q"), Q.remediation(q).alias("action"))
    place = F.row_number().over(Window.partitionBy("file_id", "action").orderBy("q", "page_id"))
    return rows.select("page_id", F.when((F.col("action") == "re-extract") & (place > 30), "over budget").otherwise(F.col("action")).alias("action"))


# ---- quality cards: each pipeline's score on what the tables hold of its inputs

_GRADE = "CASE WHEN s >= 8.0 THEN 'Excellent' WHEN s >= 5.5 THEN 'Good' WHEN s >= 4.0 THEN 'Fair' ELSE 'Poor' END"
_BAND = "CASE WHEN {0} > 20000 THEN 10 WHEN {0} > 10000 THEN 8 WHEN {0} > 5000 THEN 6 WHEN {0} > 1000 THEN 4 ELSE 2 END::DOUBLE"


def _card(rows, key, score):
    return rows.withColumn("s", score).select(key, Q.scaled(F.col("s")).alias("score"), Q.grade(F.col("s")).alias("grade"))


def _card_sql(key: str, score: str, source: str) -> str:
    return f"SELECT {key}, {_SCALED.format('s')} AS score, {_GRADE} AS grade FROM (SELECT {key}, {score} AS s FROM {source})"


_SECTION_LEN = {n: f"coalesce(length(sections['{n}']), 0)" for n in ("methods", "results", "discussion", "abstract", "introduction", "conclusions")}
_HAS = "(coalesce({}, '') <> '')::INT::DOUBLE"
_FIGURES = "len(regexp_extract_all(coalesce(text, ''), 'Figure \\d+'))"
_TABLES = "len(regexp_extract_all(coalesce(text, ''), 'Table \\d+'))"


@query(
    _card_sql(
        "result_id",
        f"0.30 * {_BAND.format('coalesce(length(text), 0)')} + 0.20 * (2 * ((coalesce(metadata.title, '') NOT IN ('', 'Untitled'))::INT::DOUBLE + coalesce((len(metadata.authors) > 0)::INT, 0)::DOUBLE + {_HAS.format('metadata.year')} + {_HAS.format('metadata.journal')} + {_HAS.format('metadata.doi')})) + 0.25 * least(10.0, 2.5 * ("
        + " + ".join(f"({_SECTION_LEN[n]} > 100)::INT::DOUBLE" for n in ("methods", "results", "discussion"))
        + ") + 0.83 * ("
        + " + ".join(f"({_SECTION_LEN[n]} > 50)::INT::DOUBLE" for n in ("abstract", "introduction", "conclusions"))
        + f")) + 0.15 * CASE WHEN {_FIGURES} = 0 THEN 5.0 ELSE least(10.0, 2.0 * {_FIGURES}) END + 0.10 * CASE WHEN {_TABLES} = 0 THEN 5.0 ELSE least(10.0, 2.5 * {_TABLES}) END",
        "extraction_result",
    )
)
def a_quality_card_paper(spark, d):
    t, m = F.coalesce("text", F.lit("")), F.col("metadata")
    sections = {n: F.coalesce(F.length(F.try_element_at("sections", F.lit(n))), F.lit(0)) for n in _SECTION_LEN}
    score = Q.paper_score(F.length(t), m["title"], F.coalesce(F.size(m["authors"]), F.lit(0)), m["year"], m["journal"], m["doi"], sections, F.regexp_count(t, F.lit(r"Figure \d+")), F.regexp_count(t, F.lit(r"Table \d+")))
    return _card(table(spark, d, "extraction_result"), "result_id", score)


_ORDER_ROWS = "(SELECT l_orderkey, count(*)::DOUBLE AS n, count_if(l_linenumber = 1)::DOUBLE AS one, count_if(l_linenumber > 1)::DOUBLE AS more, count_if(l_returnflag = 'R')::DOUBLE AS r, count_if(l_linestatus = 'F')::DOUBLE AS f, sum(l_quantity)::BIGINT::DOUBLE AS q FROM lineitem GROUP BY 1)"


def _orders(spark, d):
    c = lambda x: F.count_if(x).cast("double")
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").cast("double").alias("n"), c(F.col("l_linenumber") == 1).alias("one"), c(F.col("l_linenumber") > 1).alias("more"), c(F.col("l_returnflag") == "R").alias("r"), c(F.col("l_linestatus") == "F").alias("f"), F.sum("l_quantity").cast("bigint").cast("double").alias("q"))


@query(_card_sql("l_orderkey", "0.15 * (10.0 * n / 7) + 0.30 * (4 * (n > 0)::INT + 3 * (one > 0)::INT + 3 * (more > 0)::INT) + 0.25 * (10.0 * least(n, 5) / 5) + 0.15 * (least(7.0, 0.3 * q) + least(3.0, 0.3 * r)) + 0.15 * least(10.0, least(4.0, 0.6 * r) + least(4.0, 0.8 * f) + CASE WHEN n > 0 THEN 2.0 * f / n ELSE (r > 0)::INT::DOUBLE END)", _ORDER_ROWS))
def a_quality_card_patent(spark, d):
    c = F.col
    return _card(_orders(spark, d), "l_orderkey", Q.patent_score(c("n"), c("n"), c("one"), c("more"), F.least(c("n"), F.lit(5.0)), c("q"), c("r"), c("r"), c("f"), c("f"), c("n")))


@query(_card_sql("l_orderkey", "greatest(0.0, 0.25 * CASE WHEN q * 20 > 100 THEN least(10.0, least(10.0, q * 20 / 1000.0) + 2 * (r / n < 0.3)::INT + 2 * (q / n > 4)::INT + (one > 0)::INT) ELSE 0.0 END + 0.35 * (least(7.0, 1.5 * n) + 2 * (r > 0)::INT + (f > 0)::INT) + 0.25 * least(10.0, 3.0 * least(n, 3) + 0.5 * r) + 0.15 * greatest(0.0, 10.0 - 2.0 * f) - least(2.0, 0.5 * r) - CASE WHEN abs(n - f) > 1 THEN least(2.0, 0.5 * abs(n - f)) ELSE 0.0 END)", _ORDER_ROWS))
def a_quality_card_poster(spark, d):
    c = F.col
    score = Q.poster_score(c("q") * 20, c("r") / c("n"), c("q") / c("n"), c("one") > 0, c("n"), c("r") > 0, c("f") > 0, F.least(c("n"), F.lit(3.0)), c("r"), c("f"), c("r"), F.abs(c("n") - c("f")))
    return _card(_orders(spark, d), "l_orderkey", score)


_FILES = "(SELECT file_id, count(*)::DOUBLE AS n, sum(length(coalesce(text, '')))::DOUBLE AS chars, count_if(needs_ocr)::DOUBLE AS ocr, count_if(length(coalesce(text, '')) > 400)::DOUBLE AS full_pages, sum(len(regexp_extract_all(coalesce(text, ''), '- ')))::DOUBLE AS bullets FROM page_text GROUP BY 1)"


def _files(spark, d):
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "page_text").groupBy("file_id").agg(F.count("*").cast("double").alias("n"), F.sum(F.length(t)).cast("double").alias("chars"), F.count_if("needs_ocr").cast("double").alias("ocr"), F.count_if(F.length(t) > 400).cast("double").alias("full_pages"), F.sum(F.regexp_count(t, F.lit("- "))).cast("double").alias("bullets"))


@query(_card_sql("file_id", "0.30 * least(10.0, chars / greatest(n, 1) / 80.0) + 0.15 * CASE WHEN n > 0 THEN least(10.0, 15.0 * ocr / n) ELSE 0.0 END + 0.25 * (least(6.0, chars / 500.0) + least(4.0, 0.8 * bullets)) + 0.20 * least(10.0, 10.0 * full_pages / greatest(n, 1)) + 0.10 * CASE WHEN ocr > 0 THEN 10.0 ELSE 5.0 END", _FILES))
def a_quality_card_talk(spark, d):
    c = F.col
    return _card(_files(spark, d), "file_id", Q.talk_score(c("chars"), c("n"), c("ocr"), c("n"), c("chars"), c("bullets"), c("full_pages"), c("ocr") > 0))


@query(_card_sql("file_id", "0.30 * least(10.0, chars / greatest(n, 1) / 60.0) + 0.20 * (10.0 * full_pages / greatest(n, 1)) + 0.15 * CASE WHEN ocr = 0 THEN 7.0 ELSE 10.0 * least(ocr, full_pages) / greatest(ocr, 1) END + 0.25 * CASE WHEN chars = 0 THEN 7.0 ELSE least(6.0, chars / 400.0) + least(4.0, 0.8 * bullets) END + 0.10 * (10.0 * least(n, 4) / 4)", _FILES))
def a_quality_card_deck(spark, d):
    c = F.col
    return _card(_files(spark, d), "file_id", Q.deck_score(c("chars"), c("n"), c("full_pages"), c("ocr"), F.least(c("ocr"), c("full_pages")), c("chars"), c("bullets"), F.least(c("n"), F.lit(4.0))))


@query(_card_sql("report_id", f"0.25 * {_BAND.format('coalesce(length(title), 0) * 100')} + 0.30 * CASE WHEN a >= 20 THEN 10.0 WHEN a >= 10 THEN 8.0 WHEN a >= 5 THEN 6.0 WHEN a >= 1 THEN 4.0 ELSE 2.0 END + 0.15 * 2.5 * ({_HAS.format('title')} + (report_date IS NOT NULL)::INT::DOUBLE + (coalesce(source, 'Unknown') <> 'Unknown')::INT::DOUBLE + (coalesce(doc_type, 'other') <> 'other')::INT::DOUBLE) + 0.15 * least(10.0, 5 + 2 * coalesce((len(deals) > 0)::INT, 0) + 2 * coalesce((len(companies_mentioned) > 3)::INT, 0) + CASE WHEN a > 0 THEN 0.5 * a / a ELSE 0.0 END) + 0.15 * CASE WHEN length(title) > 40 THEN 8.0 ELSE 3.0 END", "(SELECT *, coalesce(len(assets_mentioned), 0)::DOUBLE AS a FROM ci_report)"))
def a_quality_card_ci(spark, d):
    c = F.col
    rows = table(spark, d, "ci_report").withColumn("a", F.coalesce(F.size("assets_mentioned"), F.lit(0)).cast("double")).withColumn("a", F.greatest("a", F.lit(0.0)))
    present = Q.filled(c("title")) + Q.flag(c("report_date").isNotNull()) + Q.flag(F.coalesce("source", F.lit("Unknown")) != "Unknown") + Q.flag(F.coalesce("doc_type", F.lit("other")) != "other")
    return _card(rows, "report_id", Q.report_score(F.coalesce(F.length("title"), F.lit(0)) * 100, c("a"), present, F.size("deals") > 0, F.size("companies_mentioned") > 3, 0.5 * c("a"), F.length("title") > 40))


@query(f"SELECT grade, count(*) AS n FROM (SELECT {_GRADE} AS grade FROM (SELECT quality_score.overall AS s FROM extraction_result)) WHERE grade NOT IN ('Fair', 'Poor') GROUP BY 1")
def f_quality_gate(spark, d):
    graded = table(spark, d, "extraction_result").select(Q.grade(F.col("quality_score.overall")).alias("grade"))
    return graded.filter(~F.col("grade").isin("Fair", "Poor")).groupBy("grade").agg(F.count("*").alias("n"))


# ---- aggregates

_TRIMMED = "regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT file_id, count_if(c = 'COVER') AS cover, count_if(c = 'FIGURE_PAGE') AS figure, count_if(c = 'SEARCH_REPORT') AS search, count_if(c = 'TEXT_HEAVY') AS heavy FROM (SELECT file_id, CASE WHEN page_num = 0 THEN 'COVER' WHEN page_num >= pages - 10 AND regexp_matches(coalesce(text, ''), {quoted(P.SEARCH_REPORT)}) THEN 'SEARCH_REPORT' WHEN length({_TRIMMED}) < 100 THEN 'FIGURE_PAGE' ELSE 'TEXT_HEAVY' END AS c FROM (SELECT *, count(*) OVER (PARTITION BY file_id) AS pages FROM page_text)) GROUP BY 1")
def a_class_counts_pivot(spark, d):
    pages = table(spark, d, "page_text")
    sized = pages.join(pages.groupBy("file_id").agg(F.count("*").alias("pages")), "file_id")
    classed = sized.select("file_id", P.patent_page_class(F.col("text"), F.col("page_num"), F.col("pages")).alias("c"))
    names = {"COVER": "cover", "FIGURE_PAGE": "figure", "SEARCH_REPORT": "search", "TEXT_HEAVY": "heavy"}
    counted = classed.groupBy("file_id").pivot("c", list(names)).count()
    return counted.select("file_id", *[F.coalesce(k, F.lit(0)).alias(v) for k, v in names.items()])


@query("SELECT file_id, CASE WHEN f <= t THEN (t + f) // 2 ELSE f END::BIGINT AS boundary FROM (SELECT file_id, coalesce(max(page_num) FILTER (WHERE NOT coalesce(needs_ocr, false)), 0) AS t, coalesce(min(page_num) FILTER (WHERE needs_ocr), count(*)) AS f FROM page_text GROUP BY 1)")
def a_boundary(spark, d):
    ocr = F.coalesce("needs_ocr", F.lit(False))
    seen = table(spark, d, "page_text").groupBy("file_id").agg(F.coalesce(F.max(F.when(~ocr, F.col("page_num"))), F.lit(0)).alias("t"), F.coalesce(F.min(F.when(ocr, F.col("page_num"))), F.count("*")).alias("f"))
    return seen.select("file_id", F.when(F.col("f") <= F.col("t"), F.floor((F.col("t") + F.col("f")) / 2)).otherwise(F.col("f")).cast("bigint").alias("boundary"))


_BLOCKS = "SELECT file_id, page_num, regexp_replace(l, '^\\s+|\\s+$', '', 'g') AS line FROM (SELECT file_id, page_num, unnest(string_split(text, chr(10))) AS l FROM page_text)"


@query(f"SELECT file_id, line, slides FROM (SELECT file_id, line, count(DISTINCT page_num) AS slides FROM ({_BLOCKS}) WHERE length(line) > 5 GROUP BY 1, 2) JOIN (SELECT file_id, count(DISTINCT page_num) AS n FROM ({_BLOCKS}) GROUP BY 1) USING (file_id) WHERE slides >= greatest(3, 0.15 * n)")
def a_footer(spark, d):
    blocks = table(spark, d, "page_text").select("file_id", "page_num", F.explode(F.split("text", "\n")).alias("l")).select("file_id", "page_num", X.strip(F.col("l")).alias("line"))
    return G.recurring(blocks, "file_id", "page_num", "line")


@query("SELECT file_id, count(*) AS n, strftime(min(processed_at) AT TIME ZONE 'UTC', '%Y-%m-%d') AS first_day, strftime(max(processed_at) AT TIME ZONE 'UTC', '%Y-%m-%d') AS last_day, array_to_string(list_sort(list_distinct(list(extraction_method) FILTER (WHERE extraction_method IS NOT NULL))), ',') AS methods, max(epoch_us(processed_at))::BIGINT AS newest FROM extraction_result GROUP BY 1")
def a_thread_summary(spark, d):
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, d, "extraction_result").groupBy("file_id").agg(F.count("*").alias("n"), day(F.min("processed_at")).alias("first_day"), day(F.max("processed_at")).alias("last_day"), F.array_join(F.array_sort(F.collect_set("extraction_method")), ",").alias("methods"), F.unix_micros(F.max("processed_at")).alias("newest"))


_MENTION = "SELECT doc, report_id * 1000 + pos AS ord, trim(company) AS company, name, target, types FROM (SELECT doc, report_id, company, target, types, unnest(assets_mentioned) AS name, unnest(range(1, len(assets_mentioned) + 1)) AS pos FROM (SELECT coalesce(source, '?') AS doc, report_id, unnest(companies_mentioned) AS company, doc_type AS target, assets_mentioned, list_filter(list_transform(coalesce(deals, []), lambda x: x.type), lambda x: coalesce(x, '') <> '') AS types FROM ci_report))"


@query(
    f"""WITH a AS (SELECT *, lower(trim(name)) AS k FROM ({_MENTION}) WHERE coalesce(trim(name), '') <> ''),
    u AS (SELECT doc, company, k, count(DISTINCT t) AS n FROM (SELECT doc, company, k, unnest(types) AS t FROM a) GROUP BY 1, 2, 3)
    SELECT doc AS doc_id, company, k, arg_min(name, ord) AS name, arg_min(target, ord) FILTER (WHERE coalesce(target, '') <> '') AS target, arg_min(types[1], ord) FILTER (WHERE len(types) > 0) AS stage,
    coalesce(arg_min(target, ord) FILTER (WHERE target IS NOT NULL), '') AS first_indication, coalesce(any_value(u.n), 0) AS n_updates FROM a LEFT JOIN u USING (doc, company, k) GROUP BY 1, 2, 3"""
)
def a_extraction_merge(spark, d):
    types = F.filter(F.transform(F.coalesce("deals", F.array().cast("array<struct<parties:array<string>,type:string,details:string>>")), lambda x: x["type"]), lambda x: F.coalesce(x, F.lit("")) != "")
    reports = table(spark, d, "ci_report").select(F.coalesce("source", F.lit("?")).alias("doc_id"), "report_id", F.explode("companies_mentioned").alias("company"), F.col("doc_type").alias("target"), F.col("source").alias("payload"), types.alias("types"), "assets_mentioned")
    rows = reports.select("*", F.posexplode("assets_mentioned").alias("pos", "name")).withColumn("ord", F.col("report_id") * 1000 + F.col("pos") + 1).withColumn("stage", F.get("types", F.lit(0)))
    some = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("indications", some("target")).withColumn("clinical_data", some("payload")).withColumn("updates", F.transform("types", lambda t: F.struct(t.alias("text"), F.col("indications").alias("indications"))))
    merged = G.merge_assets(rows.filter(F.coalesce(F.trim("name"), F.lit("")) != ""))
    return merged.select("doc_id", "company", F.lower(F.trim("name")).alias("k"), "name", "target", "stage", F.coalesce(F.get("indications", F.lit(0)), F.lit("")).alias("first_indication"), F.coalesce(F.when(F.col("updates").isNotNull(), F.size("updates")), F.lit(0)).cast("bigint").alias("n_updates"))


@query()
def a_extraction_merge_greedy(spark, d):
    reports = table(spark, d, "ci_report").select(F.coalesce("source", F.lit("?")).alias("doc_id"), "report_id", F.explode("companies_mentioned").alias("company"), "assets_mentioned")
    rows = reports.select("doc_id", "report_id", "company", F.posexplode("assets_mentioned").alias("pos", "name")).select("doc_id", (F.col("report_id") * 1000 + F.col("pos") + 1).alias("ord"), "company", "name")
    return G.greedy_assets(rows.filter("name is not null and company is not null"))


@query()
def j_asset_codes(spark, d):
    rows = table(spark, d, "ci_report").select("source", F.explode("assets_mentioned").alias("name")).filter("name is not null").distinct()
    return G.resolve_asset_codes(rows, ["source"], "name")


_DE, _EN = (", ".join(map(quoted, w)) for w in (P.GERMAN, P.ENGLISH))


@query(f"SELECT doc_id, CASE WHEN g + e > 0 AND g > 0.4 * (g + e) THEN 'de' ELSE 'en' END AS language FROM (SELECT doc_id, len(list_filter(w, lambda x: x IN ({_DE}))) AS g, len(list_filter(w, lambda x: x IN ({_EN}))) AS e FROM (SELECT doc_id, regexp_extract_all(lower(text[1:3000]), '[a-zäöüß]+') AS w FROM documents))")
def a_language(spark, d):
    return table(spark, d, "documents").select("doc_id", P.language(F.col("text")).alias("language"))


@query("SELECT number, arg_max(caption, length(caption) * 100000000 - page_id) AS caption FROM (SELECT page_id, unnest(regexp_extract_all(text, '(?:Figure|Fig\\.?)\\s*(\\d+)[.:]\\s*([^\\n]+)', 1))::INT AS number, unnest(regexp_extract_all(text, '(?:Figure|Fig\\.?)\\s*(\\d+)[.:]\\s*([^\\n]+)', 2)) AS caption FROM page_text) GROUP BY 1")
def a_longest_caption(spark, d):
    from leafmill.operators import generators as T

    rows = T.captions(table(spark, d, "page_text"), "page_id", "text")
    return rows.groupBy("number").agg(F.max_by("caption", F.struct(F.length("caption"), -F.col("page_id"))).alias("caption"))


@query("SELECT p_brand, p_size AS size FROM (SELECT p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_size) AS r FROM part GROUP BY 1, 2) WHERE r = 1")
def a_mode(spark, d):
    counted = table(spark, d, "part").groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    return counted.groupBy("p_brand").agg(F.max_by("p_size", F.struct("n", -F.col("p_size"))).alias("size"))


@query("SELECT file_id, arg_max(result_id, epoch_us(processed_at) * 1000 + result_id % 1000) AS result_id FROM extraction_result GROUP BY 1")
def a_latest_version(spark, d):
    return table(spark, d, "extraction_result").groupBy("file_id").agg(F.max_by("result_id", F.struct("processed_at", F.col("result_id") % 1000)).alias("result_id"))


@query("SELECT source, count(*) AS n, list_sort(list(n_chars))[(count(*) // 2 + 1)::INT] AS upper_median FROM documents WHERE source IS NOT NULL GROUP BY 1")
def a_benchmark_summary(spark, d):
    # Inverse distribution over the counted values: only one row per distinct length of a source is sorted.
    from pyspark.sql import Window

    counted = table(spark, d, "documents").filter("source is not null").groupBy("source", "n_chars").agg(F.count("*").alias("c"))
    w = Window.partitionBy("source").orderBy("n_chars")
    placed = counted.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("source")))
    return placed.filter(F.col("upto") > F.floor(F.col("n") / 2)).groupBy("source").agg(F.max("n").alias("n"), F.min("n_chars").alias("upper_median"))


@query("SELECT file_id, least(ceil(count_if(needs_ocr) / 4.0), 30)::BIGINT + 3 AS calls FROM page_text GROUP BY 1")
def a_cost_estimate(spark, d):
    return table(spark, d, "page_text").groupBy("file_id").agg((F.least(F.ceil(F.count_if("needs_ocr") / 4), F.lit(30)) + 3).cast("bigint").alias("calls"))


@query("SELECT file_id, string_agg(text, chr(10) || chr(10) ORDER BY page_num, page_id) AS joined FROM page_text WHERE regexp_replace(coalesce(text, ''), '\\s', '', 'g') <> '' GROUP BY 1")
def s_joined_text(spark, d):
    pages = table(spark, d, "page_text").filter(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s", "") != "")
    return pages.groupBy("file_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_num", "page_id", "text"))), lambda x: x["text"]), "\n\n").alias("joined"))
