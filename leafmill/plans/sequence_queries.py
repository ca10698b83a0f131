"""Windows, samples, generators and renderers over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafmill.functions import text as X
from leafmill.operators import generators as T
from leafmill.operators import render as K
from leafmill.operators import sequences as S
from leafmill.plans.registry import quoted, query
from leafmill.session import table

_LINES = "SELECT page_id, unnest(range(len(a)))::INT AS line_no, unnest(a) AS line FROM (SELECT page_id, string_split(text, chr(10)) AS a FROM page_text WHERE text IS NOT NULL)"
_TRIM = "regexp_replace(line, '^\\s+|\\s+$', '', 'g')"


def _lines(spark, d):
    return S.lines(table(spark, d, "page_text").filter("text is not null"), "page_id", "text")


# ---- windows

_NAMES = " ".join(f"WHEN regexp_matches(line, {quoted(rf'^\s*(\d+\.?\s*)?({p})\s*$')}) THEN '{n}'" for n, p in S.PAPER_SECTIONS.items())


@query(
    f"""WITH l AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY page_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM ({_LINES})),
    f AS (SELECT *, CASE {_NAMES} END AS name FROM l), o AS (SELECT *, row_number() OVER (PARTITION BY page_id, name ORDER BY line_no) AS r FROM f WHERE name IS NOT NULL),
    e AS (SELECT *, lead(start) OVER (PARTITION BY page_id ORDER BY start) AS stop FROM o WHERE r = 1),
    c AS (SELECT page_id, name, start::BIGINT AS start, regexp_replace(substring(text, (start + length(line) + 2)::BIGINT, (coalesce(stop, length(text)) - start - length(line) - 1)::BIGINT), '^\\s+|\\s+$', '', 'g') AS content FROM e JOIN page_text USING (page_id))
    SELECT page_id, name, start, length(content) AS n, md5(content) AS digest FROM c WHERE length(content) > 50"""
)
def w_sections_lead(spark, d):
    found = S.sections(table(spark, d, "page_text").filter("text is not null"), "page_id", "text")
    return found.select("page_id", "name", "start", F.length("content").cast("bigint").alias("n"), F.md5(F.col("content").cast("binary")).alias("digest"))


@query(f"SELECT page_id, line_no FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY p, line_no) AS r FROM (SELECT page_id, line_no, CASE WHEN {_TRIM} = 'CLAIMS' THEN 0 WHEN regexp_matches({_TRIM}, '^(?i)(claims|what is claimed)') THEN 1 END AS p FROM ({_LINES})) WHERE p IS NOT NULL) WHERE r = 1")
def w_header_choice(spark, d):
    bare = X.strip(F.col("line"))
    ranked = _lines(spark, d).withColumn("p", F.when(bare == "CLAIMS", 0).when(bare.rlike("^(?i)(claims|what is claimed)"), 1)).filter("p is not null")
    return S.top(ranked, ["page_id"], 1, F.col("p"), F.col("line_no")).select("page_id", "line_no")


_ISLANDS = "WITH m AS (SELECT *, {test} AS t FROM ({lines})), i AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY line_no) - row_number() OVER (PARTITION BY page_id, t ORDER BY line_no) AS g FROM m), r AS (SELECT *, count(*) OVER (PARTITION BY page_id, t, g) AS n FROM i)"
_AXIS = _ISLANDS.format(lines=_LINES, test=f"regexp_matches({_TRIM}, '^[\\d.,\\s\\-]+$') AND length({_TRIM}) < 20")


@query(f"{_AXIS} SELECT page_id, line_no, line FROM r WHERE NOT (t AND n >= 3) UNION ALL SELECT page_id, min(line_no), '[Chart axis: ' || string_agg({_TRIM}, ', ' ORDER BY line_no) || ']' FROM r WHERE t AND n >= 3 GROUP BY page_id, g")
def w_axis_runs(spark, d):
    return S.collapse_axis_numbers(_lines(spark, d), "page_id", "line_no", "line")


_FRAGMENTS = _ISLANDS.format(lines=_LINES, test=f"length({_TRIM}) <= 35 AND NOT regexp_matches({_TRIM}, '^[\\[|]')")


@query(f"{_FRAGMENTS} SELECT page_id, line_no, line FROM r WHERE NOT t UNION ALL SELECT page_id, min(line_no), string_agg({_TRIM}, ' ' ORDER BY line_no) FROM r WHERE t GROUP BY page_id, g")
def w_fragment_merge(spark, d):
    return S.merge_fragments(_lines(spark, d), "page_id", "line_no", "line")


@query("SELECT user_id, event_id, old, event_type AS new FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old FROM events) WHERE old IS NOT NULL AND old <> event_type")
def w_change_log(spark, d):
    events = table(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    log = S.change_log(events, ["user_id"], "ts", "event_id", "event_type")
    # The log's time leads back to the event; of events at one time the first with that type.
    ids = events.withColumn("old", F.lag("event_type").over(w)).select("user_id", "ts", "event_id", "old", F.col("event_type").alias("new"))
    return log.join(ids, ["user_id", "ts", "old", "new"]).select("user_id", "event_id", "old", "new")


@query("SELECT user_id, event_type, strftime(min(ts), '%Y-%m-%d') AS first_seen, strftime(max(ts), '%Y-%m-%d') AS last_seen FROM events GROUP BY 1, 2")
def w_first_last_seen(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_seen"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_seen"))


@query("SELECT file_id, batch, count(*) AS n, min(page_num) AS first_page FROM (SELECT file_id, page_num, (row_number() OVER (PARTITION BY file_id ORDER BY page_num, page_id) - 1) // 4 AS batch FROM page_text) GROUP BY 1, 2")
def w_batches(spark, d):
    ranked = table(spark, d, "page_text").withColumn("batch", F.floor((F.row_number().over(Window.partitionBy("file_id").orderBy("page_num", "page_id")) - 1) / 4))
    return ranked.groupBy("file_id", "batch").agg(F.count("*").alias("n"), F.min("page_num").alias("first_page"))


@query("SELECT user_id, max(gap)::BIGINT AS widest FROM (SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM events) WHERE gap IS NOT NULL GROUP BY 1")
def w_widest_gap(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    gaps = table(spark, d, "events").select("user_id", us.alias("t")).withColumn("gap", F.col("t") - F.lag("t").over(Window.partitionBy("user_id").orderBy("t")))
    return gaps.filter("gap is not null").groupBy("user_id").agg(F.max("gap").alias("widest"))


@query("SELECT file_id, count(*) AS kept, sum(length(coalesce(text, '')))::BIGINT AS used FROM (SELECT *, sum(length(coalesce(text, ''))) OVER (PARTITION BY file_id ORDER BY page_num, page_id) AS s FROM page_text) WHERE s <= 40000 GROUP BY 1")
def w_running_budget(spark, d):
    size = F.length(F.coalesce("text", F.lit("")))
    kept = S.within_budget(table(spark, d, "page_text"), ["file_id"], F.struct("page_num", "page_id"), size, 40000)
    return kept.groupBy("file_id").agg(F.count("*").alias("kept"), F.sum(size).alias("used"))


@query()
def w_chunks(spark, d):
    return S.chunks(table(spark, d, "extraction_result"), "result_id", "text")


# ---- top-k and samples

_SCORE = "length(coalesce(text, ''))"


@query(f"SELECT file_id, page_id, rank FROM (SELECT file_id, page_id, row_number() OVER (PARTITION BY file_id ORDER BY {_SCORE}, page_id)::INT AS rank FROM page_text) WHERE rank <= 5")
def o_worst_k(spark, d):
    return S.top(table(spark, d, "page_text"), ["file_id"], 5, F.length(F.coalesce("text", F.lit(""))), F.col("page_id")).select("file_id", "page_id", "rank")


@query("SELECT p_partkey, p_size, rank FROM (SELECT *, row_number() OVER (ORDER BY p_size DESC, p_retailprice, p_partkey)::INT AS rank FROM part) WHERE rank <= 45")
def o_multikey_topk(spark, d):
    best = table(spark, d, "part").orderBy(F.desc("p_size"), "p_retailprice", "p_partkey").limit(45)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("p_size"), "p_retailprice", "p_partkey"))).select("p_partkey", "p_size", "rank")


@query("SELECT c_nationkey, c_custkey, o_orderkey FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) c JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS q FROM orders) o ON o_custkey = c_custkey WHERE r <= 3 AND q <= 2")
def o_nested_head(spark, d):
    best = S.top(table(spark, d, "customer"), ["c_nationkey"], 3, F.desc("c_acctbal"), F.col("c_custkey")).select("c_nationkey", "c_custkey")
    orders = S.top(table(spark, d, "orders"), ["o_custkey"], 2, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")
    return best.join(orders, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "c_custkey", "o_orderkey")


@query("SELECT file_id, page_id FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY page_num, page_id) - 1 AS i, count(*) OVER (PARTITION BY file_id) AS n FROM page_text) WHERE n <= 15 OR list_contains(list_transform(range(15), lambda k: k * n // 15), i)")
def o_stride_sample(spark, d):
    return S.stride_sample(table(spark, d, "page_text"), ["file_id"], F.struct("page_num", "page_id"), 15).select("file_id", "page_id")


@query("SELECT work_id, array_to_string(list(name ORDER BY k, pos), '; ') AS authors FROM (SELECT work_id, unnest(range(len(authors))) AS pos, unnest(authors).name AS name, CASE unnest(authors).sequence WHEN 'first' THEN 0 WHEN 'additional' THEN 1 ELSE 2 END AS k FROM crossref_work) WHERE name IS NOT NULL GROUP BY 1")
def o_sequence_rank(spark, d):
    rank = lambda a: F.when(a["sequence"] == "first", 0).when(a["sequence"] == "additional", 1).otherwise(2)
    ordered = F.array_sort(F.transform(F.filter("authors", lambda a: a["name"].isNotNull()), lambda a, i: F.struct(rank(a).alias("k"), i.alias("i"), a["name"].alias("name"))))
    return table(spark, d, "crossref_work").select("work_id", F.array_join(F.transform(ordered, lambda x: x["name"]), "; ").alias("authors")).filter("authors <> ''")


# ---- generators

_CLAIMS = "string_agg(l_linenumber || '. A method of ' || CASE WHEN l_linenumber = 1 THEN 'making ' || l_returnflag ELSE 'claim ' || (l_linenumber - 1) || ' with ' || l_linestatus END, chr(10) ORDER BY l_linenumber)"


def _claim_texts(spark, d):
    n = F.col("l_linenumber")
    one = F.concat(n.cast("string"), F.lit(". A method of "), F.when(n == 1, F.concat(F.lit("making "), "l_returnflag")).otherwise(F.concat(F.lit("claim "), (n - 1).cast("string"), F.lit(" with "), "l_linestatus")))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(n.alias("n"), one.alias("c")))).alias("c"))
    return rows.select("l_orderkey", F.array_join(F.transform("c", lambda x: x["c"]), "\n").alias("text"))


@query("SELECT l_orderkey, l_linenumber AS number, CASE WHEN l_linenumber > 1 THEN l_linenumber - 1 END AS depends_on, l_linenumber = 1 AS is_independent, 'method' AS category FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def t_claims(spark, d):
    return T.claims(_claim_texts(spark, d), "l_orderkey", "text").select("l_orderkey", "number", "depends_on", "is_independent", "category")


_CAP = "'(?:Figure|Fig\\.?)\\s*(\\d+)[.:]\\s*([^\\n]+)'"


@query(f"SELECT page_id, unnest(regexp_extract_all(text, {_CAP}, 1))::INT AS number, unnest(range(len(regexp_extract_all(text, {_CAP}, 1))))::INT AS ord, regexp_replace(unnest(regexp_extract_all(text, {_CAP}, 2))[1:500], '^\\s+|\\s+$', '', 'g') AS caption FROM page_text")
def t_captions(spark, d):
    return T.captions(table(spark, d, "page_text"), "page_id", "text")


_FOUND = " UNION ALL ".join(f"SELECT doc_id, {i} AS k, '{k}' AS kind, unnest(range(len(regexp_extract_all(text, {quoted(p)}, 0)))) AS i, unnest(regexp_extract_all(text, {quoted(p)}, 0)) AS value FROM documents" for i, (k, p) in enumerate(T.METRICS))


@query(f"SELECT doc_id, kind, value, row_number() OVER (PARTITION BY doc_id ORDER BY k, i)::INT AS ord FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, value ORDER BY k, i) AS r FROM ({_FOUND})) WHERE r = 1")
def t_metrics(spark, d):
    return T.metrics(table(spark, d, "documents"), "doc_id", "text")


@query()
def t_metric_contexts(spark, d):
    return T.metric_contexts(table(spark, d, "documents"), "doc_id", "text")


_LABELS = " UNION ALL ".join(f"SELECT page_id, regexp_replace(unnest(regexp_extract_all(text, {quoted(p)}, 1)), '^\\s+|\\s+$', '', 'g') AS label, regexp_replace(unnest(regexp_extract_all(text, {quoted(p)}, 2)), '^\\s+|\\s+$', '', 'g')[1:100] AS milestone FROM page_text" for p in T.TIMELINES)


@query(_LABELS)
def t_timelines(spark, d):
    return T.timelines(table(spark, d, "page_text").filter("text is not null"), "page_id", "text")


@query(f"SELECT page_id, {_TRIM} AS action, regexp_extract(line, {quoted(T.OWNER)}, 1) AS owner, regexp_extract(line, {quoted(T.DEADLINE)}, 1) AS deadline FROM ({_LINES}) WHERE regexp_matches({_TRIM}, '^- Owner') AND length({_TRIM}) > 10")
def t_action_items(spark, d):
    return T.action_items(_lines(spark, d).filter(X.strip(F.col("line")).rlike("^- Owner")), "page_id", "line")


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{T.IDS}')))[1:20], ' ') AS ids FROM documents")
def t_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(T.ids(F.col("text")), " ").alias("ids"))


@query(f"SELECT page_id, line_no, unnest(range(len(c)))::INT AS col, unnest(c) AS cell FROM (SELECT page_id, line_no, string_split(line, ' | ') AS c FROM ({_LINES})) WHERE len(c) > 1")
def t_table_rows(spark, d):
    cells = _lines(spark, d).withColumn("c", F.split("line", r" \| ")).filter(F.size("c") > 1)
    return cells.select("page_id", "line_no", F.posexplode("c").alias("col", "cell"))


# ---- renderers


def _esc(e: str) -> str:
    return f"replace(replace(replace({e}, '\\', '\\\\'), '\"', '\\\"'), chr(10), ' ')"


@query(
    f"""SELECT result_id, '---' || chr(10) || concat_ws(chr(10), {', '.join(f"CASE WHEN coalesce(metadata.{c}, '') <> '' THEN '{c}: \"' || {_esc('metadata.' + c)} || '\"' END" for c in ('title', 'journal', 'doi', 'year'))}, '---') || chr(10) || chr(10) || '# ' || coalesce(metadata.title, 'Untitled') || chr(10) || chr(10)
    || coalesce(array_to_string(list_transform(list_filter(list_sort(map_entries(sections)), lambda s: coalesce(s.value, '') <> ''), lambda s: '## ' || upper(s.key[1:1]) || s.key[2:] || chr(10) || chr(10) || s.value), chr(10) || chr(10)), '') AS markdown FROM extraction_result"""
)
def k_markdown_doc(spark, d):
    m = F.col("metadata")
    sections = F.coalesce(F.transform(F.array_sort(F.map_entries("sections")), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("content"))), F.array().cast("array<struct<name:string,content:string>>"))
    return table(spark, d, "extraction_result").select("result_id", K.document({c: m[c] for c in ("title", "journal", "doi", "year")}, m["title"], sections).alias("markdown"))


@query("SELECT o_orderkey, '| line | flag | status |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || l_linenumber || ' | ' || l_returnflag || ' | ' || l_linestatus || ' |', chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey) AS t FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def k_table_render(spark, d):
    cells = F.array(F.col("l_linenumber").cast("string"), F.col("l_returnflag"), F.col("l_linestatus"))
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", cells.alias("c")))).alias("r"))
    rows = rows.join(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return rows.select("o_orderkey", K.table(F.array(*map(F.lit, ("line", "flag", "status"))), F.transform("r", lambda x: x["c"])).alias("t"))


@query("SELECT user_id, count(*) AS n, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS participants, '# ' || arg_max(event_type, ts) || chr(10) || chr(10) || string_agg('## ' || event_type || chr(10) || chr(10) || coalesce(props, '[Empty email body]'), chr(10) || chr(10) ORDER BY ts, '## ' || event_type || chr(10) || chr(10) || coalesce(props, '[Empty email body]')) AS markdown FROM events GROUP BY 1")
def k_thread_render(spark, d):
    out = K.thread(table(spark, d, "events"), "user_id", "ts", "event_type", "event_type", "props")
    return out.select("user_id", "n", F.array_join("participants", ",").alias("participants"), "markdown")


@query("SELECT result_id, concat_ws(chr(9), result_id::VARCHAR, coalesce(regexp_replace(metadata.title, '[\\t\\r\\n]+', ' ', 'g'), ''), coalesce(extraction_method, ''), coalesce(quality_score.grade, '')) AS line FROM extraction_result")
def k_audit_log(spark, d):
    return table(spark, d, "extraction_result").select("result_id", K.audit_line(F.col("result_id"), F.col("metadata.title"), F.col("extraction_method"), F.col("quality_score.grade")).alias("line"))


@query("SELECT page_id, concat_ws(chr(10), '### Figure ' || number || ': ' || left(caption, 20), caption, CASE WHEN caption <> left(caption, 20) THEN '*' || caption || '*' END) AS block FROM (SELECT page_id, unnest(regexp_extract_all(text, " + _CAP + ", 1))::INT AS number, regexp_replace(unnest(regexp_extract_all(text, " + _CAP + ", 2))[1:500], '^\\s+|\\s+$', '', 'g') AS caption FROM page_text)")
def k_figure_block(spark, d):
    rows = T.captions(table(spark, d, "page_text"), "page_id", "text")
    return rows.select("page_id", K.figure(F.col("number"), F.substring("caption", 1, 20), F.col("caption"), F.col("caption")).alias("block"))
