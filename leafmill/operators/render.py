"""Markdown documents, tables and threads as columns, and sinks for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import escape_cell, escape_yaml


def table(header: Column, rows: Column, most: int = 50) -> Column:
    """A pipe table: the header, a rule, and the first rows, each padded or cut to the header's width."""
    n = F.size(header)
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, escape_cell), " | "), F.lit(" |"))
    fit = lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), n)), F.lit(1), n)
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), n))
    return F.concat_ws("\n", line(header), rule, F.array_join(F.transform(F.slice(rows, 1, most), lambda r: line(fit(r))), "\n"))


def front_matter(fields: dict[str, Column]) -> Column:
    """YAML front matter; fields without a value are left out."""
    rows = [F.when(F.coalesce(c.cast("string"), F.lit("")) != "", F.concat(F.lit(f'{k}: "'), escape_yaml(c.cast("string")), F.lit('"'))) for k, c in fields.items()]
    return F.concat_ws("\n", F.lit("---"), *rows, F.lit("---"))


def document(fields: dict[str, Column], title: Column, sections: Column) -> Column:
    """A whole document; ``sections`` is an array of structs name, content."""
    body = F.transform(F.filter(sections, lambda s: F.coalesce(s["content"], F.lit("")) != ""), lambda s: F.concat(F.lit("## "), F.initcap(F.replace(s["name"], F.lit("_"), F.lit(" "))), F.lit("\n\n"), s["content"]))
    return F.concat_ws("\n\n", front_matter(fields), F.concat(F.lit("# "), F.coalesce(title, F.lit("Untitled"))), F.array_join(body, "\n\n"))


def figure(number: Column, title: Column, description: Column, caption: Column) -> Column:
    """A figure block; the caption is shown only where it says more than the title."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("### Figure "), number.cast("string"), F.coalesce(F.concat(F.lit(": "), F.nullif(title, F.lit(""))), F.lit(""))),
        F.nullif(description, F.lit("")),
        F.when((F.coalesce(caption, F.lit("")) != "") & (F.coalesce(caption, F.lit("")) != F.coalesce(title, F.lit(""))), F.concat(F.lit("*"), caption, F.lit("*"))),
    )


def thread(mails: DataFrame, key: str, at: str, sender: str, subject: str, body: str) -> DataFrame:
    """(key, n, first_at, last_at, participants, subject, markdown) of each thread, oldest mail first."""
    block = F.concat(F.lit("## "), F.coalesce(F.col(sender).cast("string"), F.lit("?")), F.lit("\n\n"), F.coalesce(F.col(body).cast("string"), F.lit("[Empty email body]")))
    rows = mails.groupBy(key).agg(
        F.count("*").alias("n"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.array_sort(F.collect_set(F.col(sender).cast("string"))).alias("participants"),
        F.max_by(subject, F.struct(at, subject)).alias("subject"),
        F.array_sort(F.collect_list(F.struct(at, block.alias("b")))).alias("blocks"),
    )
    text = F.array_join(F.transform("blocks", lambda x: x["b"]), "\n\n")
    return rows.select(key, "n", "first_at", "last_at", "participants", "subject", F.concat(F.lit("# "), F.coalesce("subject", F.lit("")), F.lit("\n\n"), text).alias("markdown"))


def audit_line(*columns: Column) -> Column:
    """A tab-separated line; tabs and line ends inside a value become blanks, null is empty."""
    return F.concat_ws("\t", *[F.coalesce(F.regexp_replace(c.cast("string"), r"[\t\r\n]+", " "), F.lit("")) for c in columns])


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("sep", "\t").option("header", True).csv(path)


def write_files(df: DataFrame, name: str, text: str, folder: str) -> DataFrame:
    """One file per row in a folder that every executor reaches; returns (name, bytes). A rerun overwrites whole files."""
    import os
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(folder, exist_ok=True)
        for b in batches:
            sizes = []
            for n, t in zip(b["n"], b["t"]):
                data = (t or "").encode()
                part = os.path.join(folder, f".{n}.{os.getpid()}")
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, os.path.join(folder, n))
                sizes.append(len(data))
            yield pd.DataFrame({"name": b["n"], "bytes": sizes})

    return df.select(F.col(name).alias("n"), F.col(text).alias("t")).mapInPandas(run, "name string, bytes long")
