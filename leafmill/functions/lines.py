"""Rules that walk over the lines of a text one after another, as plain functions and Arrow-batched columns."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What begins a quoted mail, a sign-off, and a meeting invite.
_FROM = re.compile(r"^\s*>?\s*\*?(?:From|Von|De)\s*:", re.I)
_HEADER = re.compile(r"^\s*>?\s*\*?(?:From|Von|De|Sent|Gesendet|Envoyé|To|An|À|Cc|Subject|Betreff|Objet|Date|Datum)\s*:", re.I)
SIGNATURE_MARKS = ("\n-- \n", "\n___\n", "\n---\n", "\n_____")
SIGN_OFF = re.compile(r"\n(?:(?:Mit freundlichen Gr[uü][sß]en|Best regards|Kind regards|Regards|Thanks|Cheers|Sincerely|Viele Gr[uü][sß]e|Liebe Gr[uü][sß]e|MfG|VG|BR|Sent from my iPhone|Sent from my iPad|Get Outlook for))[\s,]*\n", re.I)
_INVITE = re.compile(r"^\s*(?:Microsoft Teams meeting|Join on your computer|Join Zoom Meeting|Teilnehmen|Meeting ID|Besprechungs-ID)\b", re.I)
_RULE = re.compile(r"^\s*[_\-=*]{8,}\s*$")
# Labelled contact fields of a signature.
CONTACT = {
    "phone": re.compile(r"(?:Phone|Tel(?:efon)?|T)\s*[:|]\s*([+\d][\d\s\-().]{4,})", re.I),
    "mobile": re.compile(r"(?:Mobile|Cell(?:ular)?|Mobil|Mob|M)\s*[:|]\s*([+\d][\d\s\-().]{4,})", re.I),
    "fax": re.compile(r"Fax\s*[:|]\s*([+\d][\d\s\-().]{4,})", re.I),
    "email": re.compile(r"([\w.+\-]+@[\w.\-]+\.\w{2,})"),
    "website": re.compile(r"((?:www\.)[\w.\-/]+|https?://[\w.\-/]+)", re.I),
}
_ROLE = re.compile(r"\b(?:director|manager|scientist|head|lead|principal|senior|junior|associate|officer|engineer|analyst|professor|postdoc|researcher|consultant|specialist|president|vp|ceo|cto|cso|cmo|coo|cfo|founder|partner|chief|coordinator|advisor|fellow|student|technician|biologist|chemist|physician|statistician|architect|developer|leiter(?:in)?|direktor(?:in)?|referent(?:in)?|wissenschaftler(?:in)?)\b", re.I)
_ORG = re.compile(r"\b(?:gmbh|ag|inc|ltd|llc|corp|plc|co\.|therapeutics|pharma\w*|biotech\w*|universit\w+|institut\w*|hospital|laborator\w+|labs?)\b", re.I)
_PLACE = re.compile(r"\b\d{4,5}\b|\b(?:Germany|Deutschland|USA|UK|France|Switzerland|Austria|Spain|Netherlands|Belgium|Sweden|Denmark|Norway|Italy|Japan|China|India)\b|\b(?:street|avenue|road|platz|weg|allee)\b|str\.", re.I)
_UMLAUT = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue"})


def cut_quoted(text: str) -> str:
    """The part before the first quoted mail: a From line with two more header lines among the next six filled lines."""
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if _FROM.match(line):
            near = [x for x in lines[i : i + 20] if x.strip()][:7]
            if sum(bool(_HEADER.match(x)) for x in near) >= 3:
                return "\n".join(lines[:i]).rstrip()
    return text


def strip_invite(text: str) -> str:
    """Without meeting invites: from the line that begins one to the next rule, at most 35 lines."""
    out, skip = [], 0
    for line in text.split("\n"):
        if skip:
            skip = 0 if _RULE.match(line) else skip - 1
            continue
        if _INVITE.match(line):
            skip = 35
            continue
        out.append(line)
    return "\n".join(out)


def split_signature(text: str) -> tuple[str, str]:
    """(body, signature) at the first mark in the order of SIGNATURE_MARKS, else at a sign-off; '' without one."""
    for mark in SIGNATURE_MARKS:
        at = text.find(mark)
        if at > 0 and len(text) - at > 10:
            return text[:at].rstrip(), text[at + len(mark) :].strip()
    m = SIGN_OFF.search(text)
    if m and m.start() > 10:
        return text[: m.start()].rstrip(), text[m.start() :].strip()
    return text, ""


def contact_fields(signature: str) -> dict[str, str]:
    """Fields of a signature: labelled ones, then lines by what they name; what isn't found is left out."""
    out = {k: m.group(1).strip() for k, p in CONTACT.items() if (m := p.search(signature))}
    for line in (x.strip(" |,") for x in re.split(r"[\n|]", signature)):
        if not line or "@" in line or re.search(r"\d{5,}", line.replace(" ", "")) or CONTACT["website"].search(line):
            continue
        kind = "title" if _ROLE.search(line) else "organization" if _ORG.search(line) else "location" if _PLACE.search(line) else ""
        if kind:
            out.setdefault(kind, line)
    return out


def fold(text: str) -> str:
    """Lower case without accents, German umlauts spelled out."""
    s = unicodedata.normalize("NFKD", text.translate(_UMLAUT))
    return "".join(c for c in s if not unicodedata.combining(c)).lower()


def person_slug(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", fold(name)).strip("_") or "unknown"


def compatible(name: str) -> str:
    return unicodedata.normalize("NFKC", name)


_NAMES = re.compile(r"(?:[A-ZÀ-Þ][\w.'’\-]*\s+){1,3}[A-ZÀ-Þ][\w'’\-]+[\d*†‡§]*\s*(?:,|;| and |&)\s*(?:[A-ZÀ-Þ][\w.'’\-]*\s+){1,3}[A-ZÀ-Þ]")


def first_page_title(text: str) -> str:
    """The title on a first page: the first lines that look like one, up to 200 characters."""
    skip = re.compile(r"^(?:doi|https?:|www\.|\d+$|vol\.?|volume|article|research|review|open access|original|received|accepted|published|copyright|©|\[?\d+/?\d*\]?$|page \d+)", re.I)
    stop = re.compile(r"^(?:abstract|summary|introduction|authors?|keywords?)\b|@|^\W*$", re.I)
    held: list[str] = []
    for line in (x.strip() for x in text.split("\n")):
        if not held and (len(line) < 10 or skip.match(line)):
            continue
        if held and (stop.search(line) or _NAMES.match(line) or len(" ".join(held)) > 150 or re.search(r"[.]$", held[-1])):
            break
        held.append(line)
    return " ".join(held)[:200].strip()


def first_page_authors(text: str, most: int = 20) -> list[str]:
    """Names in the block before the abstract: comma or 'and' separated words that begin with capitals."""
    head = re.split(r"(?im)^\s*(?:abstract|summary)\b", text, maxsplit=1)[0]
    names: list[str] = []
    for line in head.split("\n")[1:12]:
        bare = re.sub(r"[\d*†‡§¹²³]+(?=,|\s|$)", "", line)
        parts = [p.strip() for p in re.split(r",|;|\band\b|&", bare) if p.strip()]
        good = [p for p in parts if re.fullmatch(r"(?:[^\W\d_][\w.'’\-]*\s+){1,3}[^\W\d_][\w'’\-]+", p) and p[0].isupper()]
        if parts and len(good) == len(parts):
            names += good
    return list(dict.fromkeys(names))[:most]


def first_page_abstract(text: str) -> str:
    """The text after an abstract header when it is longer than 200 characters, else the first long paragraph."""
    m = re.search(r"(?is)\babstract\b[\s.:—–-]*(.+?)(?=\n\s*(?:keywords?|introduction|1\.?\s+introduction|background)\b|\Z)", text)
    if m and len(m.group(1).strip()) > 200:
        return m.group(1).strip()
    return next((p.strip() for p in re.split(r"\n\s*\n", text) if len(p.strip()) > 200), "")


def model_json(answer: str) -> str | None:
    """The JSON in an answer: whole, fenced, or the first balanced object or array; cut-off arrays are closed; else null."""
    tries = [answer.strip(), *re.findall(r"```(?:json)?\s*(.*?)```", answer, re.S)]
    for opened, closed in ("{}", "[]"):
        start = answer.find(opened)
        if start >= 0:
            depth, quoted, escaped = 0, False, False
            for i, c in enumerate(answer[start:], start):
                if quoted:
                    quoted, escaped = (escaped or c != '"'), (c == "\\" and not escaped)
                elif c == '"':
                    quoted = True
                elif c in "{[":
                    depth += 1
                elif c in "}]":
                    depth -= 1
                    if not depth:
                        tries.append(answer[start : i + 1])
                        break
            else:
                whole = answer[start:].rfind("}")
                if whole > 0:
                    head = answer[start : start + whole + 1]
                    tries += [head + "]" * (head.count("[") - head.count("]")) + "}" * max(0, head.count("{") - head.count("}")), head]
    for t in tries:
        try:
            return json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True)
        except ValueError:
            continue
    return None


def ratio(a: str, b: str) -> float:
    """Ratcliff-Obershelp similarity, case apart."""
    return SequenceMatcher(None, a.lower(), b.lower()).ratio()


def column(f: Callable, kind: str) -> Callable[..., Column]:
    """A plain function as a column of Arrow batches; any null argument gives null."""

    @F.pandas_udf(kind)
    def run(*series: pd.Series) -> pd.Series:
        return pd.Series([None if any(x is None for x in row) else f(*row) for row in zip(*series)], dtype="object")

    return run
