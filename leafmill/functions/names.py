"""Names of output files and what input file names say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import safe_filename, title_slug

# Naming schemes; {x} is a column.
SCHEMES = {
    "paper": {"default": "{first_author}_{year}_{slug}", "detailed": "{first_author}_et_al_{year}_{journal}_{slug}", "doi": "{doi}"},
    "patent": {"default": "patent_{id}", "detailed": "patent_{id}_{applicant}_{slug}", "dated": "{date}_{id}_{slug}"},
    "poster": {"default": "poster_{id}", "detailed": "poster_{id}_{first_author}_{slug}"},
    "talk": {"default": "talk_{id}_{speaker}", "dated": "{date}_{id}_{speaker}", "detailed": "talk_{id}_{speaker}_{slug}"},
    "deck": {"default": "{slug}", "dated": "{date}_{slug}", "detailed": "{date}_{kind}_{slug}"},
    "report": {"default": "{kind}_{date}_{slug}", "dated": "{date}_{slug}", "detailed": "{kind}_{source}_{date}_{slug}"},
}


def output_name(pipeline: str, scheme: str, title: Column, **fields: Column) -> Column:
    """A safe name by a scheme; a missing field reads 'unknown', a missing date 'undated'."""
    import re

    values = {**fields, "slug": F.lower(title_slug(title))}
    parts = [p for p in re.split(r"(\{\w+\})", SCHEMES[pipeline][scheme]) if p]

    def value(name: str) -> Column:
        missing = F.lit("undated" if name == "date" else "unknown")
        c = values.get(name, F.lit(None)).cast("string")
        return F.regexp_replace(F.coalesce(F.nullif(c, F.lit("")), missing), r"[\s/]+", "_")

    return safe_filename(F.concat(*[value(p[1:-1]) if p.startswith("{") else F.lit(p) for p in parts], F.lit(".md")))


def poster_number(name: Column) -> Column:
    """The code at the beginning of a poster's file name, or after ' - ' at its end; '' without one."""
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    return F.upper(F.coalesce(F.nullif(F.regexp_extract(stem, r"(?i)^([A-Z]{0,4}\d{2,}[A-Z]*)", 1), F.lit("")), F.nullif(F.regexp_extract(stem, r"\s+-\s+(\d+)$", 1), F.lit("")), F.lit("")))


def talk_parts(name: Column) -> dict[str, Column]:
    """order, session, speaker, surname and title of 'NN_SESSION_Speaker_Title'; '' where a part is missing."""
    p = F.split(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""), "_", 4)
    part = lambda i: F.coalesce(F.get(p, F.lit(i)), F.lit(""))
    return {"order": part(0), "session": part(1), "speaker": part(2), "surname": F.element_at(F.split(part(2), r"\."), -1), "title": F.replace(part(3), F.lit("_"), F.lit(" "))}


def report_title(name: Column) -> Column:
    """A report's title from its file name: separators become blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, r"\.[A-Za-z0-9]+$", ""), r"[-_\s]+", " "))


def document_type(name: Column, patterns: list[tuple[str, str]]) -> Column:
    """The first of the (type, pattern) pairs that the file name matches, else 'other'."""
    out = F.when(name.isNull(), "other")
    for kind, pattern in patterns:
        out = out.when(name.rlike(pattern), kind)
    return out.otherwise("other")
