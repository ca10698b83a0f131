"""Classes and tests of pages, documents, claims, cells and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.scoring import words
from leafmill.functions.text import once, strip

REFERENCES_HEADER = r"(?md)^\s*(REFERENCES|BIBLIOGRAPHY|LITERATURE\s+CITED|References|Bibliography)\s*\n"
SEARCH_REPORT = r"(?i)INTERNATIONAL\s+SEARCH\s+REPORT|Patent\s+family\s+members"
SMILES = r"^[A-Za-z0-9@+\-\[\]()=#$/\\.%:]+$"
# Marks of how far a text may be shown, most open first.
PUBLIC_MARKS = r"for\s+public\s+release|non[\s\-]?confidential"
SECRET_MARKS = r"top\s+secret|strictly\s+confidential"
CONFIDENTIAL_MARKS = r"confidential|for\s+internal\s+use\s+only|not\s+for\s+distribution|proprietary|do\s+not\s+distribute|do\s+not\s+copy"
# Words that tell what a deck is about; whole words count.
CONTENT_WORDS = {
    "external": "partner collaboration alliance joint cro vendor external contractor outsourc codevelop",
    "project": "compound molecule target inhibitor mechanism discovery preclinical clinical pipeline candidate assay screen sar selectivity potency ic50",
    "academic": "patient study trial efficacy endpoint cohort publication abstract poster congress asco aacr esmo hypothesis method results conclusion pvalue",
    "operational": "update status progress timeline milestone deliverable team resource budget plan roadmap strategy meeting review decision action department",
}
SLIDE_BOILERPLATE = r"(?i)^(click\s+to\s+edit|insert\s+(title|subtitle|text)|thank\s+you\s*[!.]?\s*$|questions\s*\??\s*$|(any\s+)?questions\s*(\?|and\s+discussion)|appendix\s*$|backup\s+slides?\s*$)"
CLAIM_CLASSES = (
    ("composition", r"^(a|an|the)\s+(compound|composition|conjugate|antibody|polypeptide|nucleic acid|vector|cell|adc)\b"),
    ("method", r"^(a|an|the)\s+(method|process)\s"),
    ("use", r"^(use\s+of\b|.{0,30}\bfor\s+use\s+)"),
    ("pharmaceutical", r"^(a|an|the)\s+pharmaceutical"),
)
GERMAN = "und der die das ist für mit auf nicht ein eine wird bei nach auch sich von oder dem den des wie sind werden kann über zur zum alle bitte hier neue mehr wenn noch".split()
ENGLISH = "the and for with that this from are was have has been will can not but they which their would should could than other into these".split()


def paper_page_class(text: Column, page_num: Column, pages: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    at = F.regexp_instr(t, F.lit(REFERENCES_HEADER))
    return (
        F.when(page_num == 0, "TITLE_PAGE")
        .when(F.length(strip(t)) < 100, "FIGURE_PAGE")
        .when((at > 0) & (at - 1 < 0.3 * F.length(t)), "REFERENCES_PAGE")
        .when((page_num >= pages - 2) & F.lower(t).contains("supplementary"), "SUPPLEMENTARY_PAGE")
        .otherwise("TEXT_PAGE")
    )


def patent_page_class(text: Column, page_num: Column, pages: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return F.when(page_num == 0, "COVER").when((page_num >= pages - 10) & t.rlike(SEARCH_REPORT), "SEARCH_REPORT").when(F.length(strip(t)) < 100, "FIGURE_PAGE").otherwise("TEXT_HEAVY")


def document_class(pages: Column, widest: Column, head: Column, readable_of_first: Column) -> Column:
    """poster, patent, talk or paper by page count, page side in points, the first characters and the readable first pages."""
    marked = F.upper(F.substring(F.coalesce(head, F.lit("")), 1, 2000)).rlike(r"PCT/|WO \d{4}/|PATENT")
    return F.when((pages <= 3) & (widest > 2000), "poster").when(marked, "patent").when((readable_of_first == 0) & (pages > 5), "talk").otherwise("paper")


def readable(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    w = words(t)
    n = F.greatest(F.size(w), F.lit(1)).cast("double")
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]", "")) / F.greatest(F.length(t), F.lit(1)).cast("double")
    tiny = F.size(F.filter(w, lambda x: F.length(x) <= 2)) / n
    mean = F.aggregate(w, F.lit(0), lambda s, x: s + F.length(x)) / n
    return (F.length(strip(t)) >= 100) & (F.size(w) >= 20) & (letters >= 0.3) & (tiny <= 0.4) & (mean >= 3)


def ocr_page_class(text: Column) -> Column:
    """text or figure by the density of what a scanner read."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: strip(x) != "")
    n, m = F.size(words(t)), F.greatest(F.size(lines), F.lit(1)).cast("double")
    dense = (n > 100) & (n / m > 5) & (F.size(F.filter(lines, lambda x: F.length(strip(x)) > 40)) / m > 0.3)
    return F.when(n < 15, "figure").when(dense, "text").when((n < 50) | (n / m < 3), "figure").otherwise("text")


def sensitivity(name: Column, text: Column) -> Column:
    """public, confidential or secret: the highest rank that the file name or the first 10 000 characters show."""
    f, t = F.lower(F.coalesce(name, F.lit(""))), F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 10000))
    by_name = F.greatest(F.when(f.rlike(r"secret|strictly[ \-]?confidential"), 2), F.when(f.rlike("confidential|restricted|internal use"), 1), F.when(f.rlike("public|non[ _-]?con"), 0))
    by_text = F.when(t.rlike(SECRET_MARKS), 2).when(t.rlike(CONFIDENTIAL_MARKS), 1).when(t.rlike(PUBLIC_MARKS), 0)
    return F.element_at(F.array(F.lit("public"), F.lit("confidential"), F.lit("secret")), F.coalesce(F.greatest(by_name, by_text), F.lit(1)) + 1)


def content_words(text: Column) -> Column:
    """Lower-case words, with 'p-value' and 'co-develop' as one word each."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.split(F.regexp_replace(F.replace(t, F.lit("co-develop"), F.lit("codevelop")), r"p[ \-]value", "pvalue"), "[^a-z0-9]+")


def content_type(text: Column) -> Column:
    """The kind with most words; ties in the order of CONTENT_WORDS; under two words operational, blank template."""
    def pick(w: Column) -> Column:
        sizes = F.array(*[F.size(_among(w, v)) for v in CONTENT_WORDS.values()])

        def choose(n: Column) -> Column:
            out = F.when(F.array_max(n) < 2, "operational")
            for i, name in enumerate(CONTENT_WORDS):
                out = out.when(F.get(n, F.lit(i)) == F.array_max(n), name)
            return out

        return once(sizes, choose)

    return F.when(strip(F.coalesce(text, F.lit(""))) == "", "template").otherwise(once(content_words(text), pick))


def _among(w: Column, words: str) -> Column:
    return F.filter(w, lambda x: x.isin(*words.split()))


def claim_class(text: Column) -> Column:
    head = F.lower(F.substring(text, 1, 100))
    out = F.when(text.isNull(), F.lit(None).cast("string"))
    for name, pattern in CLAIM_CLASSES:
        out = out.when(head.rlike(pattern), name)
    return out.otherwise("other")


def smiles_valid(c: Column) -> Column:
    """Plausible structure string: three characters and more, of the alphabet, brackets in pairs."""
    count = lambda s: F.length(c) - F.length(F.replace(c, F.lit(s), F.lit("")))
    return F.coalesce((F.length(c) >= 3) & c.rlike(SMILES) & (count("(") == count(")")) & (count("[") == count("]")), F.lit(False))


def plausible_table(rows: Column) -> Column:
    """Rows of cells that hold a table: two in five cells filled, at most one in five of those longer than 200 characters."""
    cells = F.flatten(rows)
    full = F.filter(cells, lambda x: strip(F.coalesce(x, F.lit(""))) != "")
    lengthy = F.filter(full, lambda x: F.length(x) > 200)
    return (F.size(cells) > 0) & (F.size(full) >= 0.4 * F.size(cells)) & (F.size(lengthy) <= 0.2 * F.size(full))


def language(text: Column) -> Column:
    """de where German function words are over two in five of the known ones in the first 3000 characters, else en."""
    w = F.regexp_extract_all(F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 3000)), F.lit("[a-zäöüß]+"), 0)
    german = F.size(F.filter(w, lambda x: x.isin(*GERMAN)))
    english = F.size(F.filter(w, lambda x: x.isin(*ENGLISH)))
    return F.when((german + english > 0) & (german > 0.4 * (german + english)), "de").otherwise("en")


def allowed_host(url: Column, hosts: list[str]) -> Column:
    return F.coalesce(F.parse_url(url, F.lit("PROTOCOL")).isin("https") & F.lower(F.parse_url(url, F.lit("HOST"))).isin(*hosts), F.lit(False))
