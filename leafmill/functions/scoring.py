"""Quality scores. Every score is a double; *_scaled are the same times 10 000, rounded, as longs that add up exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import once

GARBLED_SIGNS = "~`^°¨¤¦¬¯¸¡¿§¶"


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def scaled(c: Column) -> Column:
    return F.floor(c * 10000 + 0.5).cast("long")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def page_parts(t: Column, w: Column) -> dict[str, Column]:
    """The six parts of a page's text quality, each 0 to 1, of a text and its words."""
    n = F.greatest(F.size(w), F.lit(1)).cast("double")
    chars = F.greatest(F.length(t), F.lit(1)).cast("double")
    mean = F.aggregate(w, F.lit(0), lambda s, x: s + F.length(x)) / n
    tested = F.filter(w, lambda x: (F.length(x) > 2) & x.rlike(r"^\p{L}"))
    signs = F.length(t) - F.length(F.translate(t, GARBLED_SIGNS, ""))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    return {
        "merged": F.greatest(F.lit(0.0), 1 - 5 * F.regexp_count(t, F.lit("[a-z][A-Z]")) / n),
        "average": once(mean, lambda m: F.when(m <= 7, 1.0).when(m <= 9, 1 - 0.2 * (m - 7)).otherwise(F.greatest(F.lit(0.0), 0.6 - (m - 9) / 10))),
        "long": once(tested, lambda k: F.greatest(F.lit(0.0), 1 - 10 * F.size(F.filter(k, lambda x: F.length(x) > 20)) / F.greatest(F.size(k), F.lit(1)).cast("double"))),
        "garbled": F.greatest(F.lit(0.0), 1 - 50 * signs / chars),
        "alpha": F.least(F.lit(1.0), letters / chars / 0.6),
        "tiny": F.greatest(F.lit(0.0), 1 - 2.5 * F.size(F.filter(w, lambda x: F.length(x) <= 2)) / n),
    }


PAGE_WEIGHTS = {"merged": 0.20, "average": 0.25, "long": 0.15, "garbled": 0.15, "alpha": 0.10, "tiny": 0.15}


def page_quality(text: Column) -> Column:
    """Weighted text quality of a page, 0 to 1; 0 for texts under 50 characters or 5 words, null included."""

    def score(x: Column) -> Column:
        parts = page_parts(x["t"], x["w"])
        total = F.lit(0.0)
        for name, weight in PAGE_WEIGHTS.items():
            total = total + weight * parts[name]
        return F.when((F.length(x["t"]) < 50) | (F.size(x["w"]) < 5), 0.0).otherwise(clamp(total, 0.0, 1.0))

    t = F.coalesce(text, F.lit(""))
    return once(F.struct(t.alias("t"), words(t).alias("w")), score)


def remediation(quality: Column) -> Column:
    return F.when(quality >= 0.65, "none").when(quality < 0.30, "reclassify").otherwise("re-extract")


def grade(overall: Column, poor: str = "Poor") -> Column:
    return F.when(overall >= 8.0, "Excellent").when(overall >= 5.5, "Good").when(overall >= 4.0, "Fair").otherwise(poor)


def text_band(length: Column) -> Column:
    return F.when(length > 20000, 10).when(length > 10000, 8).when(length > 5000, 6).when(length > 1000, 4).otherwise(2).cast("double")


def flag(c: Column) -> Column:
    """1.0 where true, else 0.0, null included."""
    return F.coalesce(c, F.lit(False)).cast("double")


def filled(c: Column) -> Column:
    return flag(c.isNotNull() & (c != ""))


def paper_score(text_len, title, authors_n, year, journal, doi, sections, figures, tables) -> Column:
    """``sections`` maps a section's name to its length, 0 where absent."""
    metadata = 2 * (flag((title.isNotNull()) & (title != "") & (title != "Untitled")) + flag(authors_n > 0) + filled(year) + filled(journal) + filled(doi))
    structure = F.least(F.lit(10.0), 2.5 * sum(flag(sections[s] > 100) for s in ("methods", "results", "discussion")) + 0.83 * sum(flag(sections[s] > 50) for s in ("abstract", "introduction", "conclusions")))
    figure = F.when(figures == 0, 5.0).otherwise(F.least(F.lit(10.0), 2.0 * figures))
    table = F.when(tables == 0, 5.0).otherwise(F.least(F.lit(10.0), 2.5 * tables))
    return 0.30 * text_band(text_len) + 0.20 * metadata + 0.25 * structure + 0.15 * figure + 0.10 * table


def patent_score(biblio_present, claims, independent, dependent, sections_found, figures, described, compounds, results, high, chemical) -> Column:
    biblio = 10.0 * biblio_present / 7
    claim = 4 * flag(claims > 0) + 3 * flag(independent > 0) + 3 * flag(dependent > 0)
    section = 10.0 * sections_found / 5
    figure = F.least(F.lit(7.0), 0.3 * figures) + F.least(F.lit(3.0), 0.3 * described)
    chemistry = F.least(F.lit(10.0), F.least(F.lit(4.0), 0.6 * compounds) + F.least(F.lit(4.0), 0.8 * results) + F.when(chemical > 0, 2.0 * high / chemical).otherwise(flag(compounds > 0)))
    return 0.15 * biblio + 0.30 * claim + 0.25 * section + 0.15 * figure + 0.15 * chemistry


def poster_score(text_len, tiny_ratio, mean_len, vision, figures, detailed, findings, main_sections, side_sections, contaminated, artifacts, mismatch) -> Column:
    text = F.when(text_len > 100, F.least(F.lit(10.0), F.least(F.lit(10.0), text_len / 1000.0) + 2 * flag(tiny_ratio < 0.3) + 2 * flag(mean_len > 4) + flag(vision))).otherwise(0.0)
    figure = F.least(F.lit(7.0), 1.5 * figures) + 2 * flag(detailed) + flag(findings)
    structure = F.least(F.lit(10.0), 3.0 * main_sections + 0.5 * side_sections)
    caption = F.greatest(F.lit(0.0), 10.0 - 2.0 * contaminated)
    penalty = F.least(F.lit(2.0), 0.5 * artifacts) + F.when(mismatch > 1, F.least(F.lit(2.0), 0.5 * mismatch)).otherwise(0.0)
    return F.greatest(F.lit(0.0), 0.25 * text + 0.35 * figure + 0.25 * structure + 0.15 * caption - penalty)


def talk_score(chars, slides, ocr, content, summary_len, bullets, headed, abstract) -> Column:
    n = F.greatest(slides, F.lit(1))
    coverage = F.least(F.lit(10.0), chars / n / 80.0)
    seen = F.when(content > 0, F.least(F.lit(10.0), 15.0 * ocr / content)).otherwise(0.0)
    summary = F.least(F.lit(6.0), summary_len / 500.0) + F.least(F.lit(4.0), 0.8 * bullets)
    return 0.30 * coverage + 0.15 * seen + 0.25 * summary + 0.20 * F.least(F.lit(10.0), 10.0 * headed / n) + 0.10 * F.when(abstract, 10.0).otherwise(5.0)


def deck_score(chars, slides, titled, figures, described, summary_len, bullets, metadata_present) -> Column:
    n = F.greatest(slides, F.lit(1))
    text = F.least(F.lit(10.0), chars / n / 60.0)
    visual = F.when(figures == 0, 7.0).otherwise(10.0 * described / F.greatest(figures, F.lit(1)))
    summary = F.when(summary_len == 0, 7.0).otherwise(F.least(F.lit(6.0), summary_len / 400.0) + F.least(F.lit(4.0), 0.8 * bullets))
    return 0.30 * text + 0.20 * (10.0 * titled / n) + 0.15 * visual + 0.25 * summary + 0.10 * (10.0 * metadata_present / 4)


def report_score(text_len, assets, metadata_present, deals, regulatory, staged, summary) -> Column:
    entities = F.when(assets >= 20, 10.0).when(assets >= 10, 8.0).when(assets >= 5, 6.0).when(assets >= 1, 4.0).otherwise(2.0)
    structure = F.least(F.lit(10.0), 5 + 2 * flag(deals) + 2 * flag(regulatory) + F.when(assets > 0, staged / F.greatest(assets, F.lit(1))).otherwise(0.0))
    return 0.25 * text_band(text_len) + 0.30 * entities + 0.15 * 2.5 * metadata_present + 0.15 * structure + 0.15 * F.when(summary, 8.0).otherwise(3.0)
