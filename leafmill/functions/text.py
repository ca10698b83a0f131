"""String functions as column expressions; a null input gives null unless a function says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns below must find what their names say; (?d) lets only \n end a line. Word borders are spelled
# out: Java's \b knows letters beyond ASCII, \W doesn't.
MARKDOWN_NOISE = r"[*_`#\x{FFFD}]+"
DOI = r"10\.\d{4,}/[A-Za-z0-9][A-Za-z0-9\-._/:]*"
TOKEN = "[a-z0-9]{3,}"
YEAR = r"(19[89]\d|20[012]\d)"
PAGE_HEADER = r"(?md)^(WO|EP|US) *\d{4}/?\d+ *(PCT/[A-Z]{2}\d{4}/\d+)? *$"
MARGIN_NUMBER = r'(?md)^(5|10|15|20|25|30|35|40|45|50) +([A-Za-z("])'
STRAY_LETTER = r"(?md)^[ \t]*[A-Z|l1][ \t]*$"
STRAY_SIGNS = r"(?md)^[ \t]*[!-/:-@\[-`{-~]{1,3}[ \t]*$"
BOILERPLATE = (
    r"(?md)^[^\n]{5,}\.{3,}[ \t]*\d+[ \t]*$",
    r"(?i)Page +\d+ +of +\d+",
    r"(?imd)^[ \t]*copyright[ \t]+\d{4}[^\n]{0,200}$",
    r"(?imd)^[ \t]*all[ \t]+rights[ \t]+reserved[^\n]{0,100}$",
    r"(?imd)^[ \t]*(confidential|proprietary)[ \t.]*$",
    r"(?imd)^[ \t]*inquiries[ \t]+to:[^\n]{0,80}$",
)
# Misread words of chemical texts and what they stand for, applied in this order anywhere in a text.
MISREAD_WORDS = (
    ("molecuies", "molecules"), ("molecuie", "molecule"), ("moiecuie", "molecule"), ("moiecuies", "molecules"), ("moiecuiar", "molecular"),
    ("payioads", "payloads"), ("payioad", "payload"), ("poiyubiquitination", "polyubiquitination"), ("poiy", "poly"), ("ceii", "cell"), ("ceils", "cells"),
    ("coniugate", "conjugate"), ("coniugates", "conjugates"), ("coniugated", "conjugated"), ("coniugation", "conjugation"), ("Bioconiugate", "Bioconjugate"),
    ("surpnsingly", "surprisingly"), ("particuiar", "particular"), ("particuiariy", "particularly"), ("cieavabie", "cleavable"), ("cieavable", "cleavable"),
    ("avaiiable", "available"), ("availabie", "available"), ("preferentiaiiy", "preferentially"), ("preferentiaily", "preferentially"), ("seif", "self"),
    ("haif", "half"), ("haif-iife", "half-life"), ("fiuorescent", "fluorescent"), ("fiuoro", "fluoro"), ("Olin", "Clin"), ("aikyiene", "alkylene"),
    ("aIkyI", "alkyl"), ("aikyi", "alkyl"), ("cycioaikyl", "cycloalkyl"), ("cycloaikyl", "cycloalkyl"), ("cycioalkyl", "cycloalkyl"),
    ("cycloaikyiene", "cycloalkylene"), ("heteroaikyiene", "heteroalkylene"), ("heteroaikyi", "heteroalkyl"), ("heteroaryiene", "heteroarylene"),
    ("heterocycioalkyl", "heterocycloalkyl"), ("heterocycloaikyiene", "heterocycloalkylene"), ("heterocyciyi", "heterocyclyl"),
    ("heterocyciyiene", "heterocyclylene"), ("pharmaceuticaiiy", "pharmaceutically"), ("pharmaceuticaily", "pharmaceutically"),
    ("optionaiiy", "optionally"), ("optionaily", "optionally"), ("independentiy", "independently"), ("independentIy", "independently"),
    ("denvative", "derivative"), ("pyrazoio", "pyrazolo"),
)
# Fixed values: (run-together words, words apart); applied to whole words.
MERGED_WORDS = (
    ("ofthe", "of the"), ("inthe", "in the"), ("tothe", "to the"), ("forthe", "for the"), ("fromthe", "from the"), ("withthe", "with the"), ("bythe", "by the"),
    ("onthe", "on the"), ("atthe", "at the"), ("asthe", "as the"), ("andthe", "and the"), ("isthe", "is the"), ("thatthe", "that the"),
    ("reachesthe", "reaches the"), ("explainsthe", "explains the"), ("inparticular", "in particular"), ("inpartwhy", "in part why"), ("inpart", "in part"),
    ("inorder", "in order"), ("suchthat", "such that"), ("invitro", "in vitro"), ("invivo", "in vivo"), ("aswell", "as well"), ("inwhich", "in which"),
    ("ofwhich", "of which"), ("ofclaim", "of claim"), ("offormula", "of formula"), ("toclaim", "to claim"), ("accordingto", "according to"),
    ("selectedfrom", "selected from"), ("whereinthe", "wherein the"), ("newclass", "new class"), ("areaclass", "are a class"), ("averysmall", "a very small"),
)
#: (pattern, replacement with $ groups) that set missing blanks, in order.
SPACING_FIRST = (
    (r"([a-z])([A-Z][a-z]{2,})", "$1 $2"),
    (r"(\))([A-Z])", "$1 $2"),
    (r"([a-z]\.)([A-Z][a-z]{2,})", "$1 $2"),
    (r",([A-Z][a-z]{2,})", ", $1"),
    (r"(^|\W)of([^f\s][a-z]{5,})", "$1of $2"),
)
#: (what a text must contain, pattern, replacement), in order: most texts contain none of it and are spared the pattern.
SPACING_GUARDED = (
    *((a, rf"(^|\W){a}(\W|$)", rf"$1{b}$2") for a, b in MERGED_WORDS),
    ("their", r"(^|\W)their([a-z]{4,})", "$1their $2"),
    *((f"ly{v}", rf"(^|\W)([a-z]{{4,}}ly){v}(\W|$)", rf"$1$2 {v}$3") for v in "targeting binding acting reducing promoting explaining expressed described developed produced achieved reported".split()),
)
SPACING = (*SPACING_FIRST, *((p, r) for _, p, r in SPACING_GUARDED))
# Sentences of poster templates.
TEMPLATE_LINES = (
    r"(?is)This poster template is.*?ratio\.", r"(?is)The various elements included in this.*?needs\.", r"(?is)Always check with your conference.*?requirements\.",
    r"(?i)standard copy & paste\. For best results,", r"(?i)be sure to preview your graphics at", r"(?i)Once your poster file is ready, visit",
    r"(?i)DO NOT POST[^\n]*", r"(?i)PLEASE DO NOT DISTRIBUTE[^\n]*", r"(?i)Every order receives a free design review", r"(?i)anyone in the industry; dating back to",
    r"(?is)when we helped Microsoft.*?software\.", r"(?i)return to that after trying some of the", r"(?is)Please note that graphics from websites.*?printing\.",
    r"(?is)output from PowerPoint.*?longer than",
)
#: HTML to text, in order.
HTML_STEPS = (
    (r"(?is)<style[^>]*>.*?</style>", ""),
    (r"(?is)<script[^>]*>.*?</script>", ""),
    (r"(?is)<a\s+[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>", "[$2]($1)"),
    (r"(?is)<(?:b|strong)(?:\s[^>]*)?>(.*?)</(?:b|strong)>", "**$1**"),
    (r"(?is)<(?:i|em)(?:\s[^>]*)?>(.*?)</(?:i|em)>", "*$1*"),
    (r"(?is)<li[^>]*>(.*?)</li>", "- $1\n"),
    (r"(?i)<br\s*/?\s*>", "\n"),
    (r"(?i)</p>", "\n\n"),
    (r"(?i)</?(?:div|tr)[^>]*>", "\n"),
    (r"<[^>]+>", ""),
)
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&mdash;", "—"), ("&ndash;", "–"), ("&hellip;", "…"), ("&amp;", "&"))
SUBJECT_PREFIX = r"(?i)^((re|fwd|fw|aw|wg|antwort|weitergeleitet)\s*:\s*)+"
SLUG_STOP = ("a", "an", "the", "of", "and", "in", "on", "for", "to", "with", "by", "from", "at", "is", "are", "as", "or", "via")


def strip(c: Column) -> Column:
    """Without white space at the ends; trim() knows blanks only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def once(value: Column, f) -> Column:
    """f(value) with ``value`` evaluated once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def chain(c: Column, steps) -> Column:
    for pattern, replacement in steps:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def strip_markdown(c: Column) -> Column:
    return F.regexp_replace(c, MARKDOWN_NOISE, " ")


def sanitize_title(c: Column) -> Column:
    """A title without markup and doubled white space; null gives ''."""
    return F.coalesce(strip(F.regexp_replace(strip_markdown(c), r"\s+", " ")), F.lit(""))


def clean_doi(c: Column) -> Column:
    """The first DOI in a string without trailing punctuation, else null."""
    return F.nullif(F.regexp_replace(F.regexp_extract(c, DOI, 0), r"[).,;]+$", ""), F.lit(""))


def tokens(c: Column) -> Column:
    """Distinct alphanumeric words of three characters and more, in lower case; null gives an empty array."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), 0))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays; 0 when both are empty."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def repair_misread_words(c: Column) -> Column:
    for bad, good in MISREAD_WORDS:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def repair_spacing(c: Column) -> Column:
    rules = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(p).alias("p"), F.lit(r).alias("r")) for g, p, r in SPACING_GUARDED])
    # A fold evaluates the text once per rule; nested conditions would repeat it.
    return F.aggregate(rules, chain(c, SPACING_FIRST), lambda t, x: F.when(t.contains(x["g"]), F.regexp_replace(t, x["p"], x["r"])).otherwise(t))


def remove_stray(c: Column) -> Column:
    return chain(c, ((STRAY_LETTER, ""), (STRAY_SIGNS, "")))


def squeeze_lines(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def clean_patent_text(c: Column) -> Column:
    """Page headers, margin numbers, misread words, missing blanks and stray characters removed or repaired, in this order."""
    return squeeze_lines(remove_stray(repair_spacing(repair_misread_words(chain(c, ((PAGE_HEADER, ""), (MARGIN_NUMBER, "$2")))))))


def strip_boilerplate(c: Column) -> Column:
    return squeeze_lines(chain(c, ((p, "") for p in BOILERPLATE)))


def strip_template(c: Column) -> Column:
    return F.regexp_replace(chain(c, ((p, "") for p in TEMPLATE_LINES)), r"\n\s*\n\s*\n+", "\n\n")


def html_to_text(c: Column) -> Column:
    out = chain(c, HTML_STEPS)
    for entity, sign in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return strip(F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"[ \t]+", " "))


def strip_wrapped_links(c: Column, host: str = "urldefense") -> Column:
    """Links that a mail gateway wrapped: the shown text stays, a bare link goes."""
    return chain(c, ((rf"\[([^\]]+)\]\(https?://{host}[^)]+\)", "$1"), (rf"<https?://{host}[^>]+>", "")))


def strip_banner(c: Column, start: str, end: str) -> Column:
    """Blocks that a mail gateway set between two marks."""
    return F.regexp_replace(c, rf"(?s){start}.*?{end}", "")


def normalize_subject(c: Column) -> Column:
    """A mail subject without reply and forward marks, in lower case; null and blank give 'no_subject'."""
    bare = strip(F.regexp_replace(F.coalesce(c, F.lit("")), SUBJECT_PREFIX, ""))
    return F.lower(F.when(bare == "", F.lit("no_subject")).otherwise(bare))


def thread_key(thread_id: Column, subject: Column) -> Column:
    return F.when(F.coalesce(thread_id, F.lit("")) != "", thread_id).otherwise(F.concat(F.lit("subj_"), normalize_subject(subject)))


def title_slug(c: Column, words: int = 6) -> Column:
    """The first ``words`` words that aren't stop words, joined by _; all words where only stop words are left."""
    every = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-z0-9]+"), 0)
    kept = F.filter(every, lambda w: ~F.lower(w).isin(*SLUG_STOP))
    return F.array_join(F.slice(F.when(F.size(kept) > 0, kept).otherwise(every), 1, words), "_")


def safe_filename(c: Column, longest: int = 200) -> Column:
    """A file name without control and reserved characters, cut to ``longest`` with its extension kept; never empty."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x1f\x7f]", ""), r'[<>:"/\\|?*]', "_")
    bare = F.regexp_replace(bare, r"^[. ]+|[. ]+$", "")
    reserved = F.upper(F.regexp_extract(bare, r"^([^.]*)", 1)).rlike("^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$")
    named = F.when(bare == "", F.lit("unnamed")).when(reserved, F.concat(F.lit("_"), bare)).otherwise(bare)
    ext = F.regexp_extract(named, r"(\.[A-Za-z0-9]{1,8})$", 1)
    return F.when(F.length(named) <= longest, named).otherwise(F.concat(F.substring(named, F.lit(1), F.lit(longest) - F.length(ext)), ext))


def guard_formula(c: Column) -> Column:
    """A cell that a spreadsheet would run as a formula gets a leading quote."""
    return F.when(c.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def clean_cell(c: Column) -> Column:
    return F.coalesce(strip(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def escape_cell(c: Column) -> Column:
    return F.replace(clean_cell(c), F.lit("|"), F.lit("\\|"))


def escape_yaml(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit(" "))


def surname(c: Column) -> Column:
    """The last word of a person's name, letters only."""
    return F.regexp_replace(F.element_at(F.split(strip(c), r"\s+"), -1), r"[^\p{L}\-]", "")


def paper_file(c: Column) -> tuple[Column, Column, Column]:
    """(author, year, title) of a paper's file name: 'A et al. - Y - T', 'A - Y - T' or 'A Y - T'; '' where none fits."""
    stem = F.regexp_replace(c, r"\.[A-Za-z0-9]+$", "")
    forms = (r"^(.+?) +et +al\. *[-–—] *(\d{4}) *[-–—] *(.+)$", r"^(.+?) *[-–—] *(\d{4}) *[-–—] *(.+)$", r"^(\S+) +(\d{4}) *[-–—] *(.+)$")
    pick = lambda g: F.coalesce(*[F.nullif(F.regexp_extract(stem, f, g), F.lit("")) for f in forms], F.lit(""))
    return pick(1), pick(2), pick(3)


def patent_number(c: Column) -> Column:
    """'WO<year><number><kind>' of the first publication number in a text; the kind is A1 where none is printed; else null."""
    form = r"WO\s*(\d{4})/?(\d+)\s*([A-Z]\d)?"
    number = F.concat(F.lit("WO"), F.regexp_extract(c, form, 1), F.regexp_extract(c, form, 2), F.coalesce(F.nullif(F.regexp_extract(c, form, 3), F.lit("")), F.lit("A1")))
    return F.when(c.rlike(form), number)


def between_headers(c: Column, names: list[str], ends: list[str]) -> Column:
    """The text between a header line of ``names`` and the next of ``ends`` or the end; '' where there is none."""
    return strip(F.regexp_extract(c, rf"(?is)(?:^|\n)\s*(?:{'|'.join(names)})\s*:?\s*\n(.*?)(?:\n\s*(?:{'|'.join(ends)})\s*:?\s*\n|\z)", 1))
