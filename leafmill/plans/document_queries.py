"""Queries on the checks and repairs of documents. Their SQL states its constants by itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators import documents as D
from leafmill.operators import generators as T
from leafmill.operators import merging as G
from leafmill.plans.registry import query
from leafmill.session import table

_BARE = "regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT file_id, count_if(length({_BARE}) >= 100) = 0 AND count(*) > 10 AS image_only FROM page_text GROUP BY 1")
def f_image_only(spark, d):
    heavy = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", "")) >= 100
    return D.image_only(table(spark, d, "page_text"), "file_id", heavy)


@query("SELECT page_id FROM page_text WHERE regexp_matches(coalesce(text, '')[1:2000], '(?:Claims|CLAIMS|[Ww]hat\\s+[Ii]s\\s+[Cc]laimed|WHAT\\s+IS\\s+CLAIMED)') OR len(regexp_extract_all(coalesce(text, '')[1:2000], '(?m)^\\s*(\\d+)\\.\\s+(?:A|An|The|Wherein|Said)\\s')) >= 3")
def f_claims_pages(spark, d):
    return table(spark, d, "page_text").filter(D.has_claims(F.col("text"))).select("page_id")


_STRICT, _RELAXED = r"(?m)^\s*(?:\d+\.?\s*)?(INTRODUCTION|Introduction|BACKGROUND|Background|METHODS?|Methods?|RESULTS|Results|DISCUSSION|Discussion)\s*\n", r"(?m)^\s*(?:\d+\.?\s*)?(INTRODUCTION|Introduction|BACKGROUND|Background|METHODS?|Methods?|RESULTS|Results|DISCUSSION|Discussion)[.\s]"


@query(f"SELECT doc_id, array_to_string(CASE WHEN len(s) < 3 AND len(r) > len(s) THEN r ELSE s END, '|') AS names FROM (SELECT doc_id, regexp_extract_all(text, '{_STRICT}', 1) AS s, regexp_extract_all(text, '{_RELAXED}', 1) AS r FROM documents)")
def w_section_fallback(spark, d):
    found = lambda p: F.regexp_extract_all("text", F.lit(p), 1)
    return table(spark, d, "documents").select("doc_id", F.array_join(D.strict_or_relaxed(found(_STRICT), found(_RELAXED)), "|").alias("names"))


_INVITE = "Microsoft Teams|Join the meeting|Meeting ID:|Dial in by phone|Phone conference ID|Join Zoom Meeting|zoom\\.us/j/|Google Meet|meet\\.google\\.com|Join on a video conferencing device|For organizers: Meeting options|You''re invited to|RSVP"
_CLEAN = "regexp_replace(text, '(?is)(?:Mandatory information|Pflichtangaben|Privacy Note:.*personal data|This email.*confidential|CONFIDENTIALITY NOTICE).*', '', 'g')"
for _p, _r in (("\\[([^\\]]+)\\]\\([^)]+\\)", "\\1"), ("<(?:mailto:|https?://)[^>]+>", ""), ("https?://\\S+", ""), ("_{3,}", ""), ("[ \\t]+", " "), (" *\\n *", "\n"), ("\\n{3,}", "\n"), ("^\\s+|\\s+$", "")):
    _CLEAN = f"regexp_replace({_CLEAN}, '{_p}', '{_r}', 'g')"


@query(f"SELECT doc_id, md5(CASE WHEN NOT (regexp_matches(text[1:200], '(?i){_INVITE}') OR length(c) < 15) THEN c END) AS signature FROM (SELECT doc_id, text, {_CLEAN} AS c FROM documents)")
def x_signature_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(D.clean_signature(F.col("text")).cast("binary")).alias("signature"))


_TOKENS = "list_filter(regexp_extract_all(lower(coalesce({0}, '')), '\\p{{L}}+'), lambda w: w NOT IN ('dr', 'prof', 'phd', 'md', 'msc', 'mba', 'dipl', 'ing', 'mr', 'mrs', 'ms', 'mag', 'dphil', 'pharmd', 'jr', 'sr'))"


@query(f"SELECT paper_id, ord, line FROM (SELECT paper_id, first_author, unnest(authors) AS line, unnest(range(1, len(authors) + 1)) AS ord FROM paper_meta) WHERE list_has_all({_TOKENS.format('first_author')}, {_TOKENS.format('line')})")
def j_name_lines(spark, d):
    lines = table(spark, d, "paper_meta").select("paper_id", "first_author", F.posexplode("authors").alias("ord", "line"))
    return lines.filter(D.names_only(F.col("line"), F.col("first_author"))).select("paper_id", (F.col("ord") + 1).cast("long").alias("ord"), "line")


@query("SELECT event_id, user_id FROM events WHERE props IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, props ORDER BY ts, event_id) = 1")
def u_signature_dedup(spark, d):
    rows = table(spark, d, "events").filter("props is not null")
    return G.keep_first(rows, [F.col("user_id"), F.col("props")], F.col("ts"), F.col("event_id")).select("event_id", "user_id")


_SPLIT = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: {0}contains(x, '|'))"
_TRIMMED = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


@query(
    f"SELECT page_id, len(kept) AS n, md5(array_to_string(kept, chr(10))) AS kept FROM (SELECT page_id, list_filter(blocks, lambda b: {_TRIMMED.format('b')} <> '' AND len(list_filter(cells, lambda c: c = {_TRIMMED.format('b')} OR (length(c) > 10 AND length(c) > length({_TRIMMED.format('b')}) AND contains(c, {_TRIMMED.format('b')})))) = 0) AS kept "
    f"FROM (SELECT page_id, {_SPLIT.format('NOT ')} AS blocks, list_transform(string_split(array_to_string({_SPLIT.format('')}, '|'), '|'), lambda c: {_TRIMMED.format('c')}) AS cells FROM page_text))"
)
def j_text_outside_tables(spark, d):
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    blocks, rows = F.filter(lines, lambda x: ~x.contains("|")), F.filter(lines, lambda x: x.contains("|"))
    kept = table(spark, d, "page_text").select("page_id", D.outside_tables(blocks, F.split(F.array_join(rows, "|"), r"\|")).alias("kept"))
    return kept.select("page_id", F.size("kept").cast("long").alias("n"), F.md5(F.array_join("kept", "\n").cast("binary")).alias("kept"))


_CAPTIONS = "SELECT file_id, unnest(regexp_extract_all(text, 'Table\\s*(\\d+)[.:]\\s*([^\\n]+)', 1))::INT AS number, regexp_replace(unnest(regexp_extract_all(text, 'Table\\s*(\\d+)[.:]\\s*([^\\n]+)', 2))[1:500], '^\\s+|\\s+$', '', 'g') AS caption FROM page_text"


@query(f"WITH c AS (SELECT file_id, number, min(caption) AS caption FROM ({_CAPTIONS}) GROUP BY 1, 2), t AS (SELECT file_id, page, row_number() OVER (PARTITION BY file_id ORDER BY page)::INT AS number FROM (SELECT file_id, unnest(list_distinct(pages_with_tables)) AS page FROM pdf_class)) SELECT t.file_id, t.number, t.page, c.caption FROM t LEFT JOIN c USING (file_id, number)")
def j_table_captions(spark, d):
    pages = table(spark, d, "pdf_class").select("file_id", F.explode(F.array_distinct("pages_with_tables")).alias("page"))
    captions = T.captions(table(spark, d, "page_text"), "file_id", "text", "Table").groupBy("file_id", "number").agg(F.min("caption").alias("caption"))
    return D.tables_with_captions(pages, captions, "file_id", "page").select("file_id", "number", "page", "caption")


_MENTION = " UNION ALL ".join(
    f"SELECT doc_id, {n} AS number, pos AS position, md5(regexp_replace(substr(text, greatest(pos - 200, 1), pos + length(m) + 200 - greatest(pos - 200, 1)), '^\\s+|\\s+$', '', 'g')) AS context FROM (SELECT doc_id, text, m, length(regexp_extract(text, '(?is)^(.*?)\\b(?:Fig\\.\\s*|Figure\\s+|Fig\\s+){n}\\b', 1))::INT + 1 AS pos FROM (SELECT doc_id, text, regexp_extract(text, '(?i)\\b(?:Fig\\.\\s*|Figure\\s+|Fig\\s+){n}\\b') AS m FROM documents) WHERE m <> '')"
    for n in range(1, 6)
)


@query(_MENTION)
def a_figure_mentions(spark, d):
    found = D.figure_mentions(table(spark, d, "documents"), "doc_id", "text", range(1, 6))
    return found.select("doc_id", "number", "position", F.md5(F.col("context").cast("binary")).alias("context"))


_DECKS = "SELECT file_id, ['20240131 Board update', '2023_05_09_Pipeline review', 'Kinase deck_03.04.2022', 'Review 07Mar2021 final', 'Outlook September 2020', 'Confidential [draft]_Oct 2019 plan [No Structures]', 'Plain name', '___'][(file_id % 8)::INT + 1] || CASE WHEN file_id % 3 = 0 THEN '_v' || file_id ELSE '' END AS stem FROM pdf_class"


@query(
    f"WITH s AS ({_DECKS}), a AS (SELECT file_id, stem, CASE WHEN regexp_matches(stem, '^\\d{{8}}\\b') THEN regexp_replace(stem, '^(\\d{{4}})(\\d{{2}})(\\d{{2}}).*', '\\1-\\2-\\3') WHEN regexp_matches(stem, '^\\d{{4}}_\\d\\d_\\d\\d_') THEN replace(stem[1:10], '_', '-') WHEN contains(stem, '03.04.2022') THEN '2022-04-03' WHEN contains(stem, '07Mar2021') THEN '2021-03-07' WHEN contains(stem, 'September 2020') THEN '2020-09-01' WHEN contains(stem, 'Oct 2019') THEN '2019-10-01' END AS date, "
    "CASE WHEN regexp_matches(stem, '^\\d{8}\\b') THEN stem[9:] WHEN regexp_matches(stem, '^\\d{4}_\\d\\d_\\d\\d_') THEN stem[12:] WHEN contains(stem, '_03.04.2022') THEN string_split(stem, '_03.04.2022')[1] WHEN contains(stem, '07Mar2021') THEN string_split(stem, '07Mar2021')[1] ELSE stem END AS t FROM s), "
    "b AS (SELECT *, trim(replace(trim(regexp_replace(trim(t, ' _-'), '(?i)^Confidential\\s*(\\[.*?\\])?\\s*_?', ''), ' _-'), '_', ' ')) AS u FROM a) SELECT file_id, date, CASE WHEN u = '' THEN stem ELSE u END AS title, contains(stem, '[No Structures]') AS no_structures FROM b"
)
def x_deck_name(spark, d):
    names = F.array(*map(F.lit, ("20240131 Board update", "2023_05_09_Pipeline review", "Kinase deck_03.04.2022", "Review 07Mar2021 final", "Outlook September 2020", "Confidential [draft]_Oct 2019 plan [No Structures]", "Plain name", "___")))
    stem = F.concat(F.get(names, (F.col("file_id") % 8).cast("int")), F.when(F.col("file_id") % 3 == 0, F.concat(F.lit("_v"), F.col("file_id").cast("string"))).otherwise(F.lit("")))
    return table(spark, d, "pdf_class").select("file_id", stem.alias("stem")).select("file_id", D.deck_name(F.col("stem")).alias("n")).select("file_id", "n.*")


_ANSWER = "'---SUMMARY---' || chr(10) || text || chr(10) || CASE WHEN doc_id % 3 > 0 THEN '---TAKEAWAYS---' || coalesce(source, '') ELSE '' END"


@query(f"SELECT doc_id, md5(regexp_replace(string_split(substr(a, 14), '---TAKEAWAYS---')[1], '^\\s+|\\s+$', '', 'g')) AS summary, CASE WHEN contains(a, '---TAKEAWAYS---') THEN regexp_replace(substr(a, instr(a, '---TAKEAWAYS---') + 15), '^\\s+|\\s+$', '', 'g') END AS takeaways FROM (SELECT doc_id, {_ANSWER} AS a FROM documents)")
def l_marked_sections(spark, d):
    tail = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("---TAKEAWAYS---"), F.coalesce("source", F.lit("")))).otherwise(F.lit(""))
    answers = table(spark, d, "documents").select("doc_id", F.concat(F.lit("---SUMMARY---\n"), F.col("text"), F.lit("\n"), tail).alias("a"))
    return answers.select("doc_id", F.md5(D.marked(F.col("a"), "---SUMMARY---", "---TAKEAWAYS---").cast("binary")).alias("summary"), D.marked(F.col("a"), "---TAKEAWAYS---").alias("takeaways"))


@query("SELECT page_id, unnest(regexp_extract_all(a, '(?i)Figure\\s+(\\d+):\\s*([^\\n]+)', 1)) AS number, regexp_replace(unnest(regexp_extract_all(a, '(?i)Figure\\s+(\\d+):\\s*([^\\n]+)', 2)), '^\\s+|\\s+$', '', 'g') AS description FROM (SELECT page_id, CASE WHEN page_num % 4 > 0 THEN 'FIGURE_COUNT: ' || page_num || chr(10) ELSE '' END || text || chr(10) || 'Figure ' || page_num || ': ' || coalesce(ocr_method, 'none') AS a FROM page_text WHERE text IS NOT NULL AND page_num % 4 > 0)")
def t_listed_figures(spark, d):
    head = F.when(F.col("page_num") % 4 > 0, F.concat(F.lit("FIGURE_COUNT: "), F.col("page_num").cast("string"), F.lit("\n"))).otherwise(F.lit(""))
    answers = table(spark, d, "page_text").select("page_id", F.concat(head, "text", F.lit("\nFigure "), F.col("page_num").cast("string"), F.lit(": "), F.coalesce("ocr_method", F.lit("none"))).alias("a"))
    return D.listed_figures(answers, "page_id", "a")


@query("SELECT file_id, file_name FROM pdf_class ORDER BY lower(file_name), file_name, file_id")
def o_names_in_order(spark, d):
    return table(spark, d, "pdf_class").select("file_id", "file_name").orderBy(F.lower("file_name"), "file_name", "file_id")


_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda w: w <> '')"


@query(
    f"SELECT result_id, array_to_string(list_filter([CASE WHEN length(coalesce(text, '')) < 500 THEN 'Very short text extraction (< 500 chars)' END, CASE WHEN len(list_filter({_WORDS}, lambda w: length(w) <= 2)) > 0.4 * len({_WORDS}) THEN 'High text fragmentation detected' END, "
    "CASE WHEN coalesce(length(r), 0) < 50 THEN 'Results section missing or very short' END, CASE WHEN coalesce(length(m), 0) < 50 AND coalesce(length(c), 0) < 1 THEN 'Methods and context sections (objective/background) missing' END, "
    "CASE WHEN len(f) = 0 THEN 'No figures analyzed' WHEN len(f) < 2 THEN 'Very few figures identified (expected more for typical poster)' END, CASE WHEN len(list_filter(f, lambda d: length(d) < 20)) > 0 THEN len(list_filter(f, lambda d: length(d) < 20)) || ' figures have inadequate descriptions' END], lambda x: x IS NOT NULL), '; ') AS issues "
    "FROM (SELECT result_id, text, sections['Results'] AS r, sections['Methods'] AS m, sections['Introduction'] AS c, regexp_extract_all(coalesce(text, ''), '(?:Figure|Fig\\.?)\\s*\\d+[.:]\\s*([^\\n]+)', 1) AS f FROM extraction_result)"
)
def f_output_issues(spark, d):
    section = lambda n: F.element_at("sections", n)
    figures = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?:Figure|Fig\.?)\s*\d+[.:]\s*([^\n]+)"), 1)
    notes = D.output_issues(F.col("text"), figures, section("Results"), section("Methods"), section("Introduction"))
    return table(spark, d, "extraction_result").select("result_id", F.array_join(notes, "; ").alias("issues"))


@query("SELECT l_orderkey, min(l_partkey) AS l_partkey FROM (SELECT l_orderkey, l_partkey, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS after FROM lineitem) WHERE after - l_partkey <= 30 GROUP BY 1")
def w_first_cluster(spark, d):
    return D.first_cluster(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey", "l_partkey", 30)


@query("SELECT page_id, md5(CASE WHEN NOT coalesce(length(text) >= 400, false) AND length(other) > length(coalesce(text, '')) THEN other ELSE text END) AS best FROM (SELECT p.page_id, p.text, m.other FROM page_text p LEFT JOIN (SELECT file_id, page_num, max(text) AS other FROM page_text GROUP BY 1, 2) m ON p.file_id = m.file_id AND p.page_num = m.page_num)")
def x_text_cascade(spark, d):
    pages = table(spark, d, "page_text")
    other = pages.groupBy("file_id", "page_num").agg(F.max("text").alias("other"))
    best = D.text_cascade(F.col("text"), F.col("other"), F.length("text") >= 400)
    return pages.join(other, ["file_id", "page_num"], "left").select("page_id", F.md5(best.cast("binary")).alias("best"))
