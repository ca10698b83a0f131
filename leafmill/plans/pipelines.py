"""The document pipelines as lazy plans: pages or rows in, one row per document with its Markdown and quality out.

Nothing here collects or writes; a caller writes the result, appends its log and keeps the list of what is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import lines as L
from leafmill.functions import names as N
from leafmill.functions import predicates as P
from leafmill.functions import scoring as Q
from leafmill.functions import text as X
from leafmill.operators import generators as T
from leafmill.operators import merging as G
from leafmill.operators import render as K
from leafmill.operators import sequences as S


def assemble(pages: DataFrame, key: str, page_num: str, text: str) -> DataFrame:
    """(key, text, pages, quality): the filled pages of a document in order, joined by blank lines."""
    full = pages.filter(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s", "") != "")
    rows = full.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(page_num, text))).alias("p"), F.count("*").alias("pages"), F.avg(Q.page_quality(F.col(text))).alias("quality"))
    return rows.select(key, F.array_join(F.transform("p", lambda x: x[text]), "\n\n").alias("text"), "pages", "quality")


def papers(pages: DataFrame, key: str, page_num: str, text: str, works: DataFrame | None = None) -> DataFrame:
    """Sections, metadata, score and Markdown of papers; a record of ``works`` (doi, title, journal, year) overrides the text."""
    docs = assemble(pages, key, page_num, text)
    t = F.col("text")
    metadata = docs.select(key, "text", "pages", L.column(L.first_page_title, "string")(t).alias("title"), L.column(L.first_page_authors, "array<string>")(t).alias("authors"), X.clean_doi(t).alias("doi"), F.nullif(F.regexp_extract(t, X.YEAR, 1), F.lit("")).alias("year"), L.column(L.first_page_abstract, "string")(t).alias("abstract"))
    if works is not None:
        record = works.select(F.lower("doi").alias("d"), F.col("title").alias("wt"), F.col("journal").alias("wj"), F.col("year").alias("wy")).dropDuplicates(["d"])
        metadata = metadata.join(record, F.lower(F.col("doi")) == F.col("d"), "left")
    else:
        metadata = metadata.withColumns({"wt": F.lit(None).cast("string"), "wj": F.lit(None).cast("string"), "wy": F.lit(None).cast("string")})
    found = S.sections(docs.select(key, "text"), key, "text").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "name", "content"))).alias("sections"))
    rows = metadata.join(found, key, "left").withColumn("sections", F.coalesce("sections", F.array().cast("array<struct<start:bigint,name:string,content:string>>")))
    size = {n: _section_length(n) for n in ("methods", "results", "discussion", "abstract", "introduction", "conclusions")}
    title, journal, year = F.coalesce(F.nullif(F.col("wt"), F.lit("")), "title"), F.coalesce(F.nullif(F.col("wj"), F.lit("")), F.lit("")), F.coalesce(F.nullif(F.col("wy"), F.lit("")), "year")
    score = Q.paper_score(F.length("text"), title, F.size("authors"), year, journal, F.col("doi"), size, F.regexp_count("text", F.lit(r"Figure \d+")), F.regexp_count("text", F.lit(r"Table \d+")))
    first = F.coalesce(X.surname(F.get("authors", F.lit(0))), F.lit("Unknown"))
    out = rows.select(key, title.alias("title"), "authors", journal.alias("journal"), year.alias("year"), "doi", "abstract", "sections", "pages", score.alias("score"), first.alias("first_author"))
    return out.withColumns({"grade": Q.grade(F.round("score", 1)), "file": N.output_name("paper", "default", F.col("title"), first_author=F.col("first_author"), year=F.col("year")), "markdown": K.document({"title": F.col("title"), "doi": F.col("doi"), "year": F.col("year"), "journal": F.col("journal")}, F.col("title"), F.col("sections"))})


def _section_length(name: str):
    held = F.filter("sections", lambda s: s["name"] == name)
    return F.coalesce(F.length(F.get(held, F.lit(0))["content"]), F.lit(0))


def patents(pages: DataFrame, key: str, page_num: str, text: str) -> DataFrame:
    """Number, claims with their roots, compounds, score of patents."""
    from leafmill.operators.matching import trees

    cleaned = pages.withColumn(text, X.clean_patent_text(F.col(text)))
    docs = assemble(cleaned, key, page_num, text)
    claims = T.claims(docs, key, "text")
    roots = trees(claims.select(key, "number", "depends_on"), "number", "depends_on", key)
    counted = claims.groupBy(key).agg(F.count("*").alias("claims"), F.count_if("is_independent").alias("independent"), F.count_if(~F.col("is_independent")).alias("dependent"))
    rooted = roots.groupBy(key).agg(F.count_distinct("root").alias("trees"))
    # Cleaning takes away the page headers, which print the number.
    numbers = pages.select(key, page_num, X.patent_number(F.col(text)).alias("number")).filter("number is not null").groupBy(key).agg(F.min_by("number", page_num).alias("number"))
    rows = docs.join(counted, key, "left").join(rooted, key, "left").join(numbers, key, "left").fillna(0, ["claims", "independent", "dependent", "trees"])
    number, ids = F.col("number"), T.ids(F.col("text"))
    zero = F.lit(0)
    score = Q.patent_score(Q.flag(number.isNotNull()), F.col("claims"), F.col("independent"), F.col("dependent"), zero, zero, zero, F.size(ids), zero, zero, zero)
    return rows.select(key, number.alias("number"), "claims", "independent", "dependent", "trees", ids.alias("compounds"), score.alias("score"), Q.grade(score).alias("grade"))


def decks(slides: DataFrame, key: str, number: str, blocks: str, title: str) -> DataFrame:
    """Content kind, language, recurring footers left out, metrics and score of decks. ``blocks`` is an array of strings."""
    lines = slides.select(key, number, F.explode(blocks).alias("block"))
    footers = G.recurring(lines, key, number, "block").select(key, F.col("block").alias("bare"))
    kept = lines.withColumn("bare", X.strip(F.col("block"))).join(footers, [key, "bare"], "left_anti").filter(~F.col("bare").rlike(P.SLIDE_BOILERPLATE))
    body = kept.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(number, "bare"))), lambda x: x["bare"]), "\n").alias("text"))
    counted = slides.groupBy(key).agg(F.count("*").alias("slides"), F.count_if(F.coalesce(title, F.lit("")) != "").alias("titled"))
    rows = counted.join(body, key, "left")
    chars = F.length(F.coalesce("text", F.lit("")))
    zero = F.lit(0)
    score = Q.deck_score(chars, F.col("slides"), F.col("titled"), zero, zero, zero, zero, F.lit(2))
    return rows.select(key, "slides", P.content_type(F.col("text")).alias("kind"), P.language(F.col("text")).alias("language"), P.sensitivity(F.col(key).cast("string"), F.col("text")).alias("label"), "text", score.alias("score"), Q.grade(score).alias("grade"))


def reports(rows: DataFrame, key: str, name: str, text: str, size: int = 12000) -> DataFrame:
    """(key, file, date, chunk_no, chunk): reports without boilerplate, cut for a model to read; answers come back through
    merge_assets."""
    from leafmill.functions.dates import file_date

    clean = rows.select(key, F.col(name).alias("file"), file_date(F.col(name)).alias("date"), X.strip_boilerplate(F.col(text)).alias("t"))
    return S.chunks(clean, key, "t", size).join(clean.drop("t"), key)


def mail_threads(mails: DataFrame) -> DataFrame:
    """Threads of mails (entry_id, subject, sender_email, received, body, html_body, thread_id) with rendered Markdown.

    A body is the plain text, else the HTML as text, without invites and what it quotes; a signature is taken off.
    """
    raw = F.coalesce(F.nullif(X.strip(F.col("body")), F.lit("")), F.nullif(X.html_to_text(F.col("html_body")), F.lit("")), F.lit("[Empty email body]"))
    cut = L.column(lambda t: L.split_signature(L.cut_quoted(L.strip_invite(t)))[0].strip(), "string")(X.strip_wrapped_links(raw))
    rows = mails.withColumn("thread", X.thread_key(F.col("thread_id"), F.col("subject"))).withColumn("text", cut)
    return K.thread(rows, "thread", "received", "sender_email", "subject", "text")


def contacts(mails: DataFrame) -> DataFrame:
    """(person, field, received, value): contact fields that the signatures of mails state."""
    fields = L.column(lambda t: L.contact_fields(L.split_signature(t)[1]), "map<string,string>")(F.coalesce("body", F.lit("")))
    slug = L.column(L.person_slug, "string")(F.coalesce(F.nullif("sender_name", F.lit("")), "sender_email"))
    return mails.select(slug.alias("person"), "received", "entry_id", F.explode(fields).alias("field", "value"))


def contact_changes(mails: DataFrame) -> DataFrame:
    return S.change_log(contacts(mails), ["person", "field"], "received", "entry_id", "value")
