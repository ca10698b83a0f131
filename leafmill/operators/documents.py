"""Checks and repairs of documents that are read page by page: claims pages, scanned files, figure mentions, repeats of
table cells, signatures, names of decks, and answers in marked sections. Null texts give null or nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import strip

# The header of the claims, and the beginning of a numbered claim.
CLAIMS_HEADER = r"(?:Claims|CLAIMS|[Ww]hat\s+[Ii]s\s+[Cc]laimed|WHAT\s+IS\s+CLAIMED)"
CLAIM_START = r"(?m)^\s*(\d+)\.\s+(?:A|An|The|Wherein|Said)\s"
# Words that tell a meeting invitation, and notices that end a signature.
INVITATION = r"(?i)Microsoft Teams|Join the meeting|Meeting ID:|Dial in by phone|Phone conference ID|Join Zoom Meeting|zoom\.us/j/|Google Meet|meet\.google\.com|Join on a video conferencing device|For organizers: Meeting options|You're invited to|RSVP"
NOTICE = r"(?is)(?:Mandatory information|Pflichtangaben|Privacy Note:.*personal data|This email.*confidential|CONFIDENTIALITY NOTICE).*"
LINKS = ((r"\[([^\]]+)\]\([^)]+\)", "$1"), (r"<(?:mailto:|https?://)[^>]+>", ""), (r"https?://\S+", ""), (r"_{3,}", ""), (r"[ \t]+", " "), (r" *\n *", "\n"), (r"\n{3,}", "\n"))
# What stands beside a name and isn't part of it.
HONORIFICS = ("dr", "prof", "phd", "md", "msc", "mba", "dipl", "ing", "mr", "mrs", "ms", "mag", "dphil", "pharmd", "jr", "sr")
# Dates in the names of decks, the first that is found counts: (pattern, year, month and day group, where the title is).
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_SHORT = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
_LONG = "January|February|March|April|May|June|July|August|September|October|November|December"
DECK_DATES = (
    (r"^(\d{4})(\d{2})(\d{2})\b", 1, 2, 3, "after"),
    (r"^(\d{4})_(\d{2})_(\d{2})_", 1, 2, 3, "after"),
    (r"_(\d{2})\.(\d{2})\.(\d{4})", 3, 2, 1, "before"),
    (rf"(\d{{2}})({_SHORT})(\d{{4}})", 3, 2, 1, "before"),
    (rf"({_LONG})\s+(\d{{4}})", 2, 1, 0, "all"),
    (rf"({_SHORT})\s+(\d{{4}})", 2, 1, 0, "all"),
)
CONFIDENTIAL = r"(?i)^Confidential\s*(\[.*?\])?\s*_?"


def image_only(pages: DataFrame, file: str, heavy: Column, more_than: int = 10) -> DataFrame:
    """(file, image_only): files of more than so many pages without one that is heavy in text."""
    return pages.groupBy(file).agg(((F.count_if(heavy) == 0) & (F.count("*") > more_than)).alias("image_only"))


def has_claims(text: Column, within: int = 2000) -> Column:
    """Whether the beginning of a page has the header of the claims or three numbered claims."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, within)
    return head.rlike(CLAIMS_HEADER) | (F.regexp_count(head, F.lit(CLAIM_START)) >= 3)


def strict_or_relaxed(strict: Column, relaxed: Column, enough: int = 3) -> Column:
    """The strict list where it has enough elements or no fewer than the relaxed one."""
    return F.when((F.size(strict) < enough) & (F.size(relaxed) > F.size(strict)), relaxed).otherwise(strict)


def clean_signature(c: Column, shortest: int = 15) -> Column:
    """A signature without links, rules and legal notices; null for invitations and for what is too short."""
    out = reduce(lambda x, step: F.regexp_replace(x, *step), LINKS, F.regexp_replace(c, NOTICE, ""))
    out = strip(out)
    return F.when(F.substring(c, 1, 200).rlike(INVITATION) | (F.length(out) < shortest), F.lit(None)).otherwise(out)


def name_tokens(c: Column) -> Column:
    """Words of letters of a name in lower case, without titles; none where there is an address."""
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"\p{L}+"), 0)
    kept = F.filter(words, lambda w: ~w.isin(*HONORIFICS))
    return F.when(F.coalesce(c.contains("@"), F.lit(False)), F.array().cast("array<string>")).otherwise(kept)


def names_only(line: Column, name: Column) -> Column:
    """Whether a line holds nothing but words of the name."""
    return F.size(F.array_except(name_tokens(line), name_tokens(name))) == 0


def outside_tables(blocks: Column, cells: Column, longer_than: int = 10) -> Column:
    """Blocks that aren't blank, equal to a cell, or part of a longer cell of more than so many characters."""
    cells = F.transform(cells, strip)

    def repeated(b: Column) -> Column:
        return F.exists(cells, lambda c: (c == b) | ((F.length(c) > longer_than) & (F.length(c) > F.length(b)) & c.contains(b)))

    return F.filter(blocks, lambda b: (strip(b) != "") & ~repeated(strip(b)))


def tables_with_captions(tables: DataFrame, captions: DataFrame, file: str, place: str) -> DataFrame:
    """Tables numbered in the order of their place in a file, each with the caption of that number, if any."""
    numbered = tables.withColumn("number", F.row_number().over(Window.partitionBy(file).orderBy(place)))
    return numbered.join(captions.select(file, "number", "caption"), [file, "number"], "left")


def figure_mentions(df: DataFrame, key: str, text: str, numbers: range, around: int = 200) -> DataFrame:
    """(key, number, position, context): the first mention of each figure and the text around it."""
    t = F.coalesce(F.col(text), F.lit(""))

    def one(n: int) -> Column:
        pattern = F.lit(rf"(?i)\b(?:Fig\.\s*|Figure\s+|Fig\s+){n}\b")
        at, found = F.regexp_instr(t, pattern), F.regexp_substr(t, pattern)
        start = F.greatest(at - around, F.lit(1))
        context = strip(F.substring(t, start, at + F.length(found) + around - start))
        return F.struct(F.lit(n).alias("number"), at.alias("position"), context.alias("context"))

    return df.select(key, F.explode(F.array(*map(one, numbers))).alias("m")).select(key, "m.*").filter("position > 0")


def deck_name(stem: Column) -> Column:
    """struct(date, title, no_structures) of the name of a deck without its ending."""

    def date(p: str, y: int, m: int, d: int) -> Column:
        month = F.regexp_extract(stem, p, m)
        by_name = F.lpad(F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(F.lower(month), 1, 3)).cast("string"), 2, "0")
        return F.concat_ws("-", F.regexp_extract(stem, p, y), F.when(month.rlike(r"^\d"), month).otherwise(by_name), F.regexp_extract(stem, p, d) if d else F.lit("01"))

    def title(p: str, where: str) -> Column:
        if where == "all":
            return stem
        at = F.regexp_instr(stem, F.lit(p))
        part = F.substring(stem, F.lit(1), at - 1) if where == "before" else F.substring(stem, at + F.length(F.regexp_substr(stem, F.lit(p))), F.length(stem))
        return F.regexp_replace(part, r"^[ _-]+|[ _-]+$", "")

    dates = F.coalesce(*[F.when(stem.rlike(p), date(p, y, m, d)) for p, y, m, d, _ in DECK_DATES])
    titles = F.coalesce(*[F.when(stem.rlike(p), title(p, where)) for p, *_, where in DECK_DATES], stem)
    titles = F.regexp_replace(F.regexp_replace(titles, CONFIDENTIAL, ""), r"^[ _-]+|[ _-]+$", "")
    titles = strip(F.regexp_replace(titles, "_+", " "))
    return F.struct(dates.alias("date"), F.when(titles == "", stem).otherwise(titles).alias("title"), stem.rlike(r"(?i)\[No\s+Structures\]").alias("no_structures"))


def marked(c: Column, begin: str, end: str | None = None) -> Column:
    """The text between two marks of an answer, to its end where the second is missing; null without the first."""
    after = F.substring(c, F.instr(c, begin) + len(begin), F.length(c))
    cut = after if end is None else F.when(F.instr(after, end) > 0, F.substring(after, F.lit(1), F.instr(after, end) - 1)).otherwise(after)
    return F.when(F.instr(c, begin) > 0, strip(cut))


def listed_figures(df: DataFrame, key: str, answer: str) -> DataFrame:
    """(key, number, description) of an answer that begins with a count of figures and lists them."""
    pattern = F.lit(r"(?i)Figure\s+(\d+):\s*([^\n]+)")
    pairs = F.arrays_zip(F.regexp_extract_all(answer, pattern, 1).alias("n"), F.regexp_extract_all(answer, pattern, 2).alias("d"))
    counted = df.filter(F.col(answer).rlike(r"FIGURE_COUNT:\s*\d+"))
    return counted.select(key, F.explode(pairs).alias("x")).select(key, F.col("x.n").alias("number"), strip(F.col("x.d")).alias("description"))


# What an output can lack.
SHORT_TEXT = "Very short text extraction (< 500 chars)"
FRAGMENTED = "High text fragmentation detected"
NO_RESULTS = "Results section missing or very short"
NO_METHODS = "Methods and context sections (objective/background) missing"
NO_FIGURES = "No figures analyzed"
FEW_FIGURES = "Very few figures identified (expected more for typical poster)"
POOR_FIGURES = " figures have inadequate descriptions"


def output_issues(text: Column, descriptions: Column, results: Column, methods: Column, context: Column) -> Column:
    """What an output lacks, as an array of notes; ``descriptions`` has one string per figure, ``context`` is what may stand in
    for the methods. Nulls count as missing."""
    text, figures = F.coalesce(text, F.lit("")), F.coalesce(descriptions, F.array().cast("array<string>"))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    short = lambda c, n: F.coalesce(F.length(c), F.lit(0)) < n
    poor = F.size(F.filter(figures, lambda d: short(d, 20)))
    notes = F.array(
        F.when(F.length(text) < 500, SHORT_TEXT),
        F.when(F.size(F.filter(words, lambda w: F.length(w) <= 2)) > 0.4 * F.size(words), FRAGMENTED),
        F.when(short(results, 50), NO_RESULTS),
        F.when(short(methods, 50) & short(context, 1), NO_METHODS),
        F.when(F.size(figures) == 0, NO_FIGURES).when(F.size(figures) < 2, FEW_FIGURES),
        F.when(poor > 0, F.concat(poor.cast("string"), F.lit(POOR_FIGURES))),
    )
    return F.filter(notes, lambda n: n.isNotNull())


def first_cluster(df: DataFrame, group: str, place: str, within: float) -> DataFrame:
    """(group, place): the first place of each group whose next one is no further than ``within``; groups without one are left out."""
    after = F.lead(place).over(Window.partitionBy(group).orderBy(place))
    return df.withColumn("__after", after).filter(F.col("__after") - F.col(place) <= within).groupBy(group).agg(F.min(place).alias(place))


def text_cascade(native: Column, other: Column, readable: Column) -> Column:
    """The native text, unless it isn't readable and the other is longer."""
    longer = F.coalesce(F.length(other), F.lit(0)) > F.coalesce(F.length(native), F.lit(0))
    return F.when(~F.coalesce(readable, F.lit(False)) & longer, other).otherwise(native)
