"""Finding and restoring text that was decoded with the wrong character encoding.

Every distinct clean word of the corpus (and every distinct run of non-ASCII characters) is sent through all encoding
chains; the garbled forms make a table that the words of the documents are hash-joined against. A match is taken only
where the original is verified as the likelier of the two, and its original is put in its place. A word is judged by its
own form first; one whose form could stand in clean text is judged by the other words of its page under the same chain.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialize, spread

# Fixed values: (written as, read as) steps of the chains.
WRITTEN_UTF8 = ("cp1252", "latin-1", "cp1250", "cp1251", "cp1254", "cp437", "cp850", "cp866", "koi8-r", "mac_roman", "iso8859-2", "iso8859-15", "gbk", "big5", "shift_jis", "euc_kr")
WRITTEN_SINGLE = tuple(("cp1252", d) for d in ("mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8-r", "cp866", "cp1253")) + tuple((e, "cp1252") for e in ("mac_roman", "cp437", "cp850"))
TWICE = ("cp1252", "latin-1", "cp1250", "mac_roman", "cp437", "cp850")
CHAINS: tuple[tuple[tuple[str, str], ...], ...] = (
    *(((("utf-8", d)),) for d in WRITTEN_UTF8),
    *(((e, d),) for e, d in WRITTEN_SINGLE),
    *((("utf-8", a), ("utf-8", b)) for a in TWICE for b in TWICE if a == b or {a, b} == {"cp1252", "latin-1"}),
    *((("utf-8", "cp1252"),) * 3, (("utf-8", "latin-1"),) * 3),
)
_MULTI = {"utf-8", "gbk", "big5", "shift_jis", "euc_kr"}
#: A replaced character must be this much rarer than the character it stands for, in chains that keep the length.
RARER = 0.1
#: Characters of these kinds, and these signs, don't stand between two letters of a word.
_FOREIGN, _FOREIGN_SIGNS = {"So", "Sk", "Sc", "Sm", "No", "Lm", "Lo", "Cc", "Co"}, set("¡¿„‚†‡•‰«»¶§")
_ASCII_EDGE = r"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$"


def _reader(codec: str):
    """bytes -> str; single bytes that the codec leaves undefined become the control of that number."""
    if codec in _MULTI:
        return lambda b: b.decode(codec, "replace")
    table = [bytes([i]).decode(codec, "ignore") or chr(i) for i in range(256)]
    return lambda b: "".join([table[x] for x in b])


def _writer(codec: str):
    if codec in _MULTI:
        return lambda s: s.encode(codec)
    table = {(bytes([i]).decode(codec, "ignore") or chr(i)): i for i in range(256)}

    def write(s: str) -> bytes:
        return bytes([table[c] for c in s])

    return write


def _compiled():
    """Chain steps as functions, without the trailing UTF-8 round trips repeated."""
    codecs = {c for chain in CHAINS for step in chain for c in step}
    read, write = {c: _reader(c) for c in codecs}, {c: _writer(c) for c in codecs}
    return [(chain, [(write[e], read[d]) for e, d in chain]) for chain in CHAINS]


def garbled_forms(word: str, chains=None) -> dict[str, int]:
    """Each garbled form of a word with the number of its chain (the first that gives it)."""
    out: dict[str, int] = {}
    for i, (_, steps) in enumerate(chains or _compiled()):
        s = word
        try:
            for write, read in steps:
                s = read(write(s))
        except (KeyError, UnicodeEncodeError):
            continue
        if s != word:
            out.setdefault(s, i)
    return out


def _tokens(text: Column) -> Column:
    return F.split(text, r"[ \n\t\r]+")


def _core(token: Column) -> Column:
    """A token without ASCII punctuation at its ends and with every number as 0."""
    return F.regexp_replace(F.regexp_replace(token, _ASCII_EDGE, ""), r"[0-9]+", "0")


def _strong(g: str, v: str, df_g: int, df_v: int, chars: dict[str, int], inner: dict[str, int]) -> bool:
    """Whether v is verified as the original of g; ``chars`` counts characters, ``inner`` those between small letters."""
    if "�" in v or any(unicodedata.category(c) in ("Cc", "Co") for c in v):
        return False
    if len(g) > len(v):
        return any(not c.isalpha() or not c.isascii() for c in g)
    cjk = [c for c in g if "㐀" <= c <= "鿿" or "가" <= c <= "힯" or "가" <= c <= "힣"]
    if cjk and not any("㐀" <= c <= "힯" for c in v):
        return df_v > df_g
    if len(g) < len(v):
        return False
    changed = [(a, b) for a, b in zip(g, v) if a != b]
    # Inside a word a character is rare or not among its like there: capitals hardly ever stand between small letters.
    counts = [inner if v[i - 1 : i].islower() and v[i + 1 : i + 2].islower() else chars for i, (a, b) in enumerate(zip(g, v)) if a != b]
    if df_v <= df_g or not all(n.get(a, 0) < RARER * n.get(b, 0) for (a, b), n in zip(changed, counts)):
        return False
    return sum(c.isalpha() for c in v) >= 3 or all(unicodedata.category(a) in ("So", "Cc", "Co", "Sk") for a, _ in changed)


@lru_cache(maxsize=1 << 14)
def _script(c: str) -> str:
    return unicodedata.name(c, "").split(" ")[0] if c.isalpha() else ""


def _misplaced(word: str, at: set[int]) -> bool:
    """Whether one of the characters at ``at`` can't stand where it stands in a clean word, by the others of the word."""
    kept = [i for i in range(len(word)) if i not in at]
    letters = [word[i] for i in kept if word[i].isalpha()]
    latin = len(letters) > 1 and all(_script(c) == "LATIN" for c in letters)
    for i in at:
        c = word[i]
        left, right = next((word[k] for k in reversed(kept) if k < i), ""), next((word[k] for k in kept if k > i), "")
        if "─" <= c <= "▟" and (left.isalpha() or right.isalpha()):
            return True
        if left.isalpha() and right.isalpha() and (unicodedata.category(c) in _FOREIGN or c in _FOREIGN_SIGNS):
            return True
        if latin and c.isalpha() and _script(c) != "LATIN" or c.isupper() and left.islower() and right.islower():
            return True
    return False


def _by_form(g: str, v: str) -> tuple[bool, bool]:
    """(whether the form of g alone shows that v is its original, whether v can be it at all), in chains that keep the length."""
    if len(g) != len(v) or sum(c.isalpha() for c in v) < 3 or "�" in v or any(unicodedata.category(c) in ("Cc", "Co") for c in v):
        return False, False
    at = {i for i, (a, b) in enumerate(zip(g, v)) if a != b}
    sound = not _misplaced(v, at)
    return sound and _misplaced(g, at), sound


def garble_table(pages: DataFrame, text: str, file: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(words, runs): garbled form ``core`` and original ``v`` of words and of non-ASCII runs of the corpus.

    A word is ``sure``, or needs other words of its page that are garbled by one of its ``chains``; such a word must be
    rarer than its original, each ``file`` counted once. What is shared with all tasks are two counts of each non-ASCII character, at most one entry per code point.
    """
    tokens = pages.select((F.col(file) if file else F.lit(None)).alias("f"), F.explode(_tokens(F.col(text))).alias("token")).filter(F.col("token").rlike(r"[^\x00-\x7F]"))
    by_file = tokens.select("f", _core(F.col("token")).alias("core")).groupBy("core", "f").agg(F.count("*").alias("n"))
    types = materialize(by_file.groupBy("core").agg(F.sum("n").alias("df"), (F.count("*") if file else F.sum("n")).alias("files")), "types")
    runs = materialize(types.select(F.explode(F.regexp_extract_all("core", F.lit(r"[^\x00-\x7F]+"), 0)).alias("core"), "df", "files").groupBy("core").agg(F.sum("df").alias("df"), F.sum("files").alias("files")), "runs")
    chars = {r.c: r.n for r in runs.select(F.explode(F.split("core", "")).alias("c"), "df").filter("c <> ''").groupBy("c").agg(F.sum("df").alias("n")).collect()}
    between = F.explode(F.regexp_extract_all("core", F.lit(r"(?<=\p{Ll})[^\x00-\x7F](?=\p{Ll})"), 0)).alias("c")
    inner = {r.c: r.n for r in types.select(between, "df").groupBy("c").agg(F.sum("df").alias("n")).collect()}
    shared = pages.sparkSession.sparkContext.broadcast((chars, inner))

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, chains = shared.value[0], _compiled()
        for b in batches:
            rows = []
            for v, n, m in zip(b["core"], b["df"], b["files"]):
                if "�" in v:
                    continue
                for g, i in garbled_forms(v, chains).items():
                    if all(c.isascii() or c in known for c in g):
                        rows.append((g, v, n, i, m))
            yield pd.DataFrame(rows, columns=["core", "v", "df_v", "chain", "files_v"])

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (known, within), chains = shared.value, _compiled()
        for b in batches:
            rows = []
            for g, v, n, n_v, i, m, m_v in zip(b["core"], b["v"], b["df"], b["df_v"], b["chain"], b["files"], b["files_v"]):
                shown, sound = _by_form(g, v)
                sure = shown or _strong(g, v, n, n_v, known, within)
                if sure or sound and m_v > m:
                    rows.append((g, v, n_v, i, sure, [k for k, x in enumerate(chains) if g in garbled_forms(v, [x])] if len(g) == len(v) else []))
            yield pd.DataFrame(rows, columns=["core", "v", "df_v", "chain", "sure", "chains"])

    def match(kinds: DataFrame) -> DataFrame:
        made = spread(kinds).mapInPandas(forms, "core string, v string, df_v long, chain int, files_v long")
        return kinds.join(made, "core").select("core", "v", "df", "df_v", "chain", "files", "files_v").mapInPandas(verified, "core string, v string, df_v long, chain int, sure boolean, chains array<int>")

    best = match(types).groupBy("core").agg(F.max_by(F.struct("v", "sure", "chains"), F.struct("sure", "df_v", -F.col("chain"), "v")).alias("best"), F.collect_set(F.struct("v", "sure", "chains")).alias("all"))
    words = best.select("core", F.inline(F.when(F.col("best.sure"), F.array("best")).otherwise(F.col("all"))))
    sure_runs = match(runs).filter("sure").groupBy("core").agg(F.max_by("v", F.struct("df_v", -F.col("chain"), "v")).alias("v"))
    # A run stands by itself only where the garbling made it longer: no clean text holds such runs.
    longer = sure_runs.filter(F.length("core") > F.length("v"))
    return materialize(words, "words"), materialize(longer, "longer")


def _evidence(pages: DataFrame, key: str, text: str, words: DataFrame, runs: DataFrame) -> DataFrame:
    """(key, token, core, v): garbled tokens of each page; ``v`` null where only runs are known or nothing can be."""
    tokens = pages.select(F.col(key).alias("k"), F.explode(F.array_distinct(_tokens(F.col(text)))).alias("token")).filter(F.col("token").rlike(r"[^\x00-\x7F]"))
    cored = tokens.withColumn("core", _core(F.col("token")))
    hits = materialize(cored.join(words, "core").select("k", "token", "core", "v", "sure", "chains"), "hits")
    # A word whose form decides nothing counts where a sure word, or another such word, of its page has the same chain.
    by_chain = hits.select("k", "token", "core", "v", "sure", F.explode("chains").alias("chain"))
    backed = by_chain.groupBy("k", "chain").agg(F.max("sure").alias("shown"), F.count_distinct("core").alias("n")).filter("shown or n > 1")
    unsure = by_chain.filter("not sure").join(backed, ["k", "chain"]).groupBy("k", "token", "core").agg(F.max_by("v", F.struct("shown", "n", "v")).alias("v"))
    by_word = hits.filter("sure").select("k", "token", "core", "v").unionByName(unsure.select("k", "token", "core", "v"))
    parts = cored.select("k", "token", F.explode(F.regexp_extract_all("core", F.lit(r"[^\x00-\x7F]+"), 0)).alias("core"))
    by_run = parts.join(runs, "core").select("k", "token", "core", "v")
    return by_word.withColumn("whole", F.lit(True)).unionByName(by_run.withColumn("whole", F.lit(False)))


def garbled(pages: DataFrame, key: str, text: str, file: str | None = None) -> DataFrame:
    """(key): rows whose text holds wrongly decoded characters, U+FFFD included, restorable or not.

    Null and empty texts are never garbled; every repeated row counts; only the named columns are read. ``file``
    names what a row is part of, if anything: a word counts once in each.
    """
    words, runs = garble_table(pages, text, file)
    hit = _evidence(pages, key, text, words, runs).select(F.col("k").alias(key))
    lost = pages.filter(F.col(text).contains("�")).select(key)
    return hit.unionByName(lost).distinct()


def restored(pages: DataFrame, key: str, text: str, file: str | None = None) -> DataFrame:
    """(key, text, replaced, lost): the garbled rows with verified originals in place, the number of replaced tokens,
    and whether characters remain that can't be restored. Rows without garbled tokens are not returned."""
    words, runs = garble_table(pages, text, file)
    kind = pages.schema[key].dataType.simpleString()
    found = _evidence(pages, key, text, words, runs).groupBy("k").agg(F.collect_set(F.struct("token", "core", "v", "whole")).alias("found"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, t, found in zip(b["k"], b["t"], b["found"]):
                swap: dict[str, str] = {}
                for f in sorted(found, key=lambda f: (not f["whole"], -len(f["core"]))):
                    token = f["token"]
                    now = swap.get(token, token)
                    if f["whole"]:
                        swap[token] = _put(token, f["core"], f["v"])
                    elif f["core"] in now:
                        swap[token] = now.replace(f["core"], f["v"])
                new = "".join(swap.get(p, p) for p in re.split(r"([ \n\t\r]+)", t))
                out.append((k, new, len(swap), "�" in new))
            yield pd.DataFrame(out, columns=[key, "text", "replaced", "lost"])

    rows = pages.select(F.col(key).alias("k"), F.col(text).alias("t")).join(found, "k")
    return rows.mapInPandas(run, f"`{key}` {kind}, text string, replaced int, lost boolean")


def _put(token: str, core: str, v: str) -> str:
    """The token with its core replaced by the original, its numbers kept."""
    numbers = re.findall(r"[0-9]+", token)
    shaped = re.sub(r"[0-9]+", "0", token)
    made = shaped.replace(core, v, 1)
    if made.count("0") != len(numbers):
        return token
    kept = iter(numbers)
    return re.sub("0", lambda _: next(kept), made)
