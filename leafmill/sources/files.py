"""Folder scans, office files and mails, read with the standard library only."""

from __future__ import annotations

import email
import email.policy
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def scan(spark: SparkSession, folder: str, extensions: tuple[str, ...], recursive: bool = False, most_bytes: int = 200_000_000) -> DataFrame:
    """(path, name, size_bytes, modified, content) of the files of a folder; larger ones are never opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.filter(F.col("length") <= most_bytes).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"), "content")


def _numbered(names: list[str], pattern: str) -> list[str]:
    found = [(int(m.group(1)), n) for n in names if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(found)]


def pptx_slides(content: bytes) -> list[tuple[int, str, list[str], list[list[list[str]]], str]]:
    """(number, title, text blocks, tables, notes) of each slide; [] for what isn't a presentation."""
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
        names = z.namelist()
        out = []
        for number, name in enumerate(_numbered(names, r"ppt/slides/slide(\d+)\.xml"), 1):
            root = ElementTree.fromstring(z.read(name))
            tables = [[["".join(t.text or "" for t in c.iter(f"{_A}t")) for c in r.iter(f"{_A}tc")] for r in t.iter(f"{_A}tr")] for t in root.iter(f"{_A}tbl")]
            inside = {id(p) for t in root.iter(f"{_A}tbl") for p in t.iter(f"{_A}p")}
            blocks = [s for p in root.iter(f"{_A}p") if id(p) not in inside and (s := "".join(t.text or "" for t in p.iter(f"{_A}t")).strip())]
            note = f"ppt/notesSlides/notesSlide{number}.xml"
            notes = "\n".join("".join(t.text or "" for t in p.iter(f"{_A}t")) for p in ElementTree.fromstring(z.read(note)).iter(f"{_A}p")).strip() if note in names else ""
            out.append((number, blocks[0] if blocks else "", blocks, tables, notes))
        return out
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError):
        return []


def docx_paragraphs(content: bytes) -> list[tuple[int, str, str]]:
    """(ord, style, text) of each paragraph with text; [] for what isn't a document."""
    try:
        root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml"))
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError):
        return []
    out = []
    for p in root.iter(f"{_W}p"):
        text = "".join(t.text or "" for t in p.iter(f"{_W}t")).strip()
        style = next((s.get(f"{_W}val") or "" for s in p.iter(f"{_W}pStyle")), "")
        if text:
            out.append((len(out), style, text))
    return out


def xlsx_rows(content: bytes, most: int = 500) -> list[tuple[str, int, list[str]]]:
    """(sheet, row, cells) of the first ``most`` rows of each sheet; [] for what isn't a workbook."""
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{_S}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_S}si")]
        titles = [s.get("name") or "" for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_S}sheet")]
        out = []
        for i, name in enumerate(_numbered(z.namelist(), r"xl/worksheets/sheet(\d+)\.xml")):
            for j, row in enumerate(ElementTree.fromstring(z.read(name)).iter(f"{_S}row")):
                if j >= most:
                    break
                cells = []
                for c in row.iter(f"{_S}c"):
                    v = c.find(f"{_S}v")
                    text = "".join(t.text or "" for t in c.iter(f"{_S}t")) if v is None else v.text or ""
                    cells.append(shared[int(text)] if c.get("t") == "s" and text.isdigit() and int(text) < len(shared) else text)
                out.append((titles[i] if i < len(titles) else name, j, cells))
        return out
    except (zipfile.BadZipFile, ElementTree.ParseError, KeyError):
        return []


def active_content(content: bytes) -> bool | None:
    """Whether an office file holds macros or ActiveX parts; null for what isn't an archive."""
    try:
        return any("vbaProject" in n or "activeX" in n for n in zipfile.ZipFile(io.BytesIO(content)).namelist())
    except zipfile.BadZipFile:
        return None


def _parsed(files: DataFrame, parse, fields: str, names: list[str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(p, *row) for p, c in zip(b["path"], b["content"]) for row in parse(bytes(c))], columns=["path", *names])

    return files.select("path", "content").mapInPandas(run, f"path string, {fields}")


def slides(files: DataFrame) -> DataFrame:
    return _parsed(files, pptx_slides, "number int, title string, text_blocks array<string>, tables array<array<array<string>>>, notes string", ["number", "title", "text_blocks", "tables", "notes"])


def paragraphs(files: DataFrame) -> DataFrame:
    return _parsed(files, docx_paragraphs, "ord int, style string, text string", ["ord", "style", "text"])


def sheet_rows(files: DataFrame, most: int = 500) -> DataFrame:
    return _parsed(files, lambda c: xlsx_rows(c, most), "sheet string, row int, cells array<string>", ["sheet", "row", "cells"])


MAIL = "entry_id string, subject string, sender_name string, sender_email string, received timestamp, body string, html_body string, thread_id string, `to` array<string>, cc array<string>, attachments array<struct<name: string, size_bytes: bigint>>"


def parse_mail(content: bytes) -> tuple:
    """One mail in the fields of MAIL; what a mail lacks is '' or empty."""
    from email.utils import getaddresses, parseaddr, parsedate_to_datetime

    m = email.message_from_bytes(content, policy=email.policy.default)
    name, address = parseaddr(str(m.get("From", "")))
    try:
        at = parsedate_to_datetime(str(m["Date"])).astimezone(__import__("datetime").timezone.utc).replace(tzinfo=None) if m["Date"] else None
    except (ValueError, TypeError):
        at = None
    plain, rich = m.get_body(("plain",)), m.get_body(("html",))
    people = lambda h: [a for _, a in getaddresses([str(x) for x in m.get_all(h, [])]) if a]
    files = [(a.get_filename() or "", len(a.get_payload(decode=True) or b"")) for a in m.iter_attachments()]
    return (str(m.get("Message-ID", "")), str(m.get("Subject", "")), name, address, at, plain.get_content() if plain else "", rich.get_content() if rich else "", str(m.get("Thread-Topic-Id", m.get("References", "")) or "").split(" ")[0], people("To"), people("Cc"), files)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _MailReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder = options["path"]

    def partitions(self) -> list[InputPartition]:
        import os

        return [_File(os.path.join(d, f)) for d, _, fs in sorted(os.walk(self.folder)) for f in sorted(fs) if f.endswith(".eml")]

    def read(self, part: _File) -> Iterator[tuple]:
        with open(part.path, "rb") as f:
            yield parse_mail(f.read())


class _MailStream(SimpleDataSourceStreamReader):
    """New files by name; a restart goes on after the last name seen."""

    def __init__(self, options: dict) -> None:
        self.folder = options["path"]

    def initialOffset(self) -> dict:  # noqa: N802
        return {"after": ""}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        import os

        new = sorted(f for f in os.listdir(self.folder) if f.endswith(".eml") and f > start["after"])
        return iter([self._one(f) for f in new]), {"after": new[-1] if new else start["after"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        import os

        return iter([self._one(f) for f in sorted(os.listdir(self.folder)) if f.endswith(".eml") and start["after"] < f <= end["after"]])

    def _one(self, name: str) -> tuple:
        with open(f"{self.folder}/{name}", "rb") as f:
            return parse_mail(f.read())


class MailSource(DataSource):
    """spark.read.format("mail").load(folder) and spark.readStream.format("mail"): a row per .eml file."""

    @classmethod
    def name(cls) -> str:
        return "mail"

    def schema(self) -> str:
        return MAIL

    def reader(self, schema) -> DataSourceReader:
        return _MailReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return _MailStream(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MailSource)
