"""One consistent form for texts that look the same.

Invisible characters go, spaces and widths are unified, accents are composed, ligatures opened. Look-alike letters are
then judged token by token: in a token of mixed scripts the letters outside its dominant script are replaced where the
result is a word of the corpus; a token made of look-alikes only takes the script of its nearest unambiguous neighbour
under the same condition.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialize

# Letters of other scripts that are drawn like Latin ones.
CYRILLIC = dict(zip("асеорхуѕіјһԁԛԝӏѵүАВЕКМНОРСТХУЅІЈҺԚԜӀѴҮԌ", "aceopxysijhdqwlvyABEKMHOPCTXYSIJhQWIVYG"))
CYRILLIC |= {"ї": "ï", "ё": "ë", "ѐ": "è", "Ї": "Ï", "Ё": "Ë", "Ѐ": "È"}
GREEK = dict(zip("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϳϹ", "ovABEZHIKMNOPTYXcjC"))
ARMENIAN = dict(zip("ոսօհզցյՍՕՏԼ", "nuohqgjUOSL"))
LATIN_KIN = dict(zip("ɡɑᴏᴄᴠᴡᴢꜱ", "gaocvwzs"))
TO_LATIN = CYRILLIC | GREEK | ARMENIAN | LATIN_KIN
FROM_LATIN = {
    "cyrillic": {v: k for k, v in reversed(list(CYRILLIC.items())) if k in "асеорхуѕіјАВЕКМНОРСТХУЅІЈ"},
    "greek": {v: k for k, v in reversed(list(GREEK.items()))},
    "armenian": {v: k for k, v in reversed(list(ARMENIAN.items()))},
}
# Signs drawn alike, and Latin letters drawn like Greek ones.
SIGNS = dict(zip("‐‑﹣ʼ՚＇˚⁄∕∶꞉ǃ∣ǀ∗․µ", "---’’'°//::!||*.μ")) | dict(zip("ꞵꭓꞷɸɣɩ", "βχωφγι")) | dict(zip("ϐϑϰϱϕ⍺", "βθκρφα"))
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "ǉ": "lj", "ǌ": "nj", "ǆ": "dž", "℃": "°C", "℉": "°F"}
ROMAN = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0x2160, 0x2180)}
WIDE = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFF01, 0xFFEF) if unicodedata.decomposition(chr(c)).startswith(("<wide>", "<narrow>"))}
# White space of other widths, line breaks, and characters that are drawn as nothing.
SPACES = "".join(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
BREAKS = "".join(map(chr, (0x85, 0x2028, 0x2029)))
JOINERS = "".join(map(chr, (0x200C, 0x200D, 0xFE0F)))
INVISIBLE = "".join(map(chr, (0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x180F), *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF)))

_SIMPLE = str.maketrans({**SIGNS, **LIGATURES, **ROMAN, **WIDE, **dict.fromkeys(SPACES, " "), **dict.fromkeys(BREAKS, "\n")})
#: A joiner keeps its place between letters of scripts whose shapes it changes, and in pictographs.
_INVISIBLE = re.compile(f"[{''.join(c for c in INVISIBLE if c not in JOINERS)}\U000e0100-\U000e01ef]|(?<![\u0600-\u08ff\u0900-\u0dff\u2190-\u2bff\U0001f000-\U0001ffff])[{JOINERS}]")
_TRAIL = re.compile(r"[ \t]+(?=\n|\Z)")
_ODD = "".join(TO_LATIN)
#: Texts that Spark can bring to form by itself: ASCII, the letters and signs of Latin-1 that stand for themselves, and
#: common punctuation and Greek letters that no rule here touches.
ORDINARY = r"\A[\x{0}-\x{84}\x{86}-\x{9f}\x{a1}-\x{ac}\x{ae}-\x{ff}\x{2013}\x{2014}\x{2018}-\x{201e}\x{2026}\x{20ac}\x{2212}\x{2248}\x{2264}\x{2265}\x{394}\x{3b1}-\x{3b8}\x{3ba}-\x{3bc}\x{3c0}-\x{3c9}]*\z"
#: Words that are sent to all tasks, at most.
SENT = 200_000
_WORD = re.compile(r"[^\W_]+(?:[\u0300-\u036f]+[^\W_]*)*")
_HAS_ODD = re.compile("[" + _ODD + "]")
#: Token borders for the corpus vocabulary; the same words that _WORD finds.
NOT_WORD = r"[^\p{L}\p{N}\p{M}]+"


def script(ch: str) -> str:
    """Coarse script of a letter; '' for what has none."""
    o = ord(ch)
    if o < 0x370:
        return "latin" if ch.isalpha() and ch != "µ" else ""
    if o < 0x400:
        return "greek"
    if o < 0x530:
        return "cyrillic"
    if o < 0x590:
        return "armenian"
    return "latin" if ch in LATIN_KIN or 0x1E00 <= o < 0x1F00 else "greek" if 0x1F00 <= o < 0x2000 else "other" if ch.isalpha() else ""


def plain_form(text: str) -> str:
    """The form before look-alike letters are judged."""
    out = _INVISIBLE.sub("", text.replace("\r\n", "\n")).translate(_SIMPLE)
    return _TRAIL.sub("", unicodedata.normalize("NFC", out))


def _dominant(word: str) -> tuple[str, bool]:
    """The script of most letters of a word that no look-alike explains, and whether the word holds several scripts."""
    firm: dict[str, int] = {}
    seen = set()
    for ch in word:
        s = script(ch)
        if s:
            seen.add(s)
            if ch not in TO_LATIN and not (s == "latin" and any(ch in m for m in FROM_LATIN.values())):
                firm[s] = firm.get(s, 0) + 2
            else:
                firm[s] = firm.get(s, 0) + 1
    if not firm:
        return "", False
    top = max(firm.items(), key=lambda x: (x[1], x[0] == "latin"))[0]
    return top, len(seen) > 1


def _into(word: str, target: str) -> str:
    if target == "latin":
        return "".join(TO_LATIN.get(c, c) for c in word)
    table = FROM_LATIN.get(target, {})
    return "".join(table.get(c, c) if script(c) == "latin" else table.get(TO_LATIN.get(c, ""), c) if c in TO_LATIN and script(c) != target else c for c in word)


def suspects(form: str) -> dict[str, list[str]]:
    """Words of a text that may hold look-alikes, each with the forms it could stand for, likeliest first."""
    out: dict[str, list[str]] = {}
    words = None
    for m in _WORD.finditer(form):
        word = m.group()
        if word.isascii() or not _HAS_ODD.search(word):
            continue
        top, mixed = _dominant(word)
        if mixed:
            order = [top, "latin"] if top != "latin" else ["latin", *(s for s in FROM_LATIN if any(script(c) == s for c in word))]
        elif top != "latin" and all(c in TO_LATIN or not c.isalpha() for c in word):
            if words is None:
                words = [(w.start(), w.group()) for w in _WORD.finditer(form)]
            if _neighbour(words, m.start()) != "latin":
                continue
            order = ["latin"]
        elif top == "latin":
            order = ["latin"]
        else:
            continue
        # What still mixes scripts ('μM') is asked for only where no look-alike is left in it.
        options = [x for x in dict.fromkeys(_into(word, s) for s in order) if x != word and (not _dominant(x)[1] or not _HAS_ODD.search(x))]
        if options:
            out[word] = options
    return out


def _neighbour(words: list[tuple[int, str]], at: int) -> str:
    """Script of the nearest word whose letters aren't all look-alikes, the one before it first."""
    import bisect

    i = bisect.bisect_left(words, (at, ""))
    for step in range(1, max(i, len(words) - i) + 1):
        for j in (i - step, i + step):
            if 0 <= j < len(words):
                firm = [script(c) for c in words[j][1] if c.isalpha() and c not in TO_LATIN]
                if firm:
                    return firm[0]
    return "latin"


def _replace(form: str, good: dict[str, str]) -> str:
    return _WORD.sub(lambda m: good.get(m.group(), m.group()), form)


def consistent_forms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, form): the consistent form of every text.

    A null text has a null form, an empty one an empty form. Texts without special characters never leave the JVM.
    Repeated keys with different texts each get a row. Only the two named columns are read.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    special = F.col("t").isNotNull() & (F.octet_length("t") > F.length("t")) & ~F.col("t").rlike(ORDINARY)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            forms = [plain_form(t) for t in b["t"]]
            found = [suspects(f) if _HAS_ODD.search(f) else {} for f in forms]
            yield pd.DataFrame({"k": b["k"], "form": forms, "words": [list(s) for s in found], "options": [list(s.values()) for s in found]})

    odd = materialize(rows.filter(special).mapInPandas(first, f"k {kind}, form string, words array<string>, options array<array<string>>"), "odd")
    asked = odd.select(F.explode(F.flatten("options")).alias("word")).distinct()
    asked = materialize(asked, "asked")
    # Few asked words go to the corpus, so that only the words found are shuffled; many meet its distinct words by a join.
    corpus = _words(rows.select("t"))
    words = corpus.join(F.broadcast(asked), "word").distinct() if asked.limit(SENT + 1).count() <= SENT else corpus.distinct().join(asked, "word", "left_semi")
    pairs = odd.filter(F.size("words") > 0).select("k", F.xxhash64("form").alias("h"), F.posexplode(F.arrays_zip("words", "options"))).select("k", "h", F.col("col.words").alias("old"), F.posexplode("col.options").alias("rank", "word"))
    good = pairs.join(words, "word").groupBy("k", "h", "old").agg(F.min_by("word", "rank").alias("new")).groupBy("k", "h").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("good"))

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "form": [_replace(f, dict(g)) for f, g in zip(b["form"], b["good"])]})

    hashed = odd.withColumn("h", F.xxhash64("form")).drop("words", "options")
    repaired = hashed.join(good, ["k", "h"]).select("k", "form", "good").mapInPandas(second, f"k {kind}, form string")
    kept = hashed.join(good, ["k", "h"], "left_anti").select("k", "form")
    plain = rows.filter(F.col("t").isNull() | ~special).select("k", _jvm_form(F.col("t")).alias("form"))
    return plain.unionByName(repaired).unionByName(kept).select(F.col("k").alias(key), "form")


def _jvm_form(t: Column) -> Column:
    """plain_form for texts without special characters."""
    out = F.replace(F.replace(t, F.lit("µ"), F.lit("μ")), F.lit("\r\n"), F.lit("\n"))
    trailing = out.contains(" \n") | out.contains("\t\n") | out.endswith(" ") | out.endswith("\t")
    return F.when(trailing, F.regexp_replace(out, r"[ \t]+(?=\n|\z)", "")).otherwise(out)


def _words(texts: DataFrame) -> DataFrame:
    """Words of all texts. What is looked up here holds no look-alikes, so words with some can't match."""
    return texts.select(F.explode(F.array_distinct(F.split("t", NOT_WORD))).alias("word"))


def form_classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, form_class, text_class, links): a row per text that isn't null, in time that doesn't grow with the pairs.

    Texts of one ``form_class`` look the same, those of one ``text_class`` are the same string; ``links`` counts the
    texts that look the same but aren't. Classes are digests, so they are the same in every run.
    """
    raw = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.md5(F.col(text).cast("binary")).alias("raw"))
    forms = consistent_forms(docs, key, text).filter("form is not null").select(F.col(key).alias("k"), F.md5(F.col("form").cast("binary")).alias("f"))
    ids = raw.join(forms, "k")
    sizes = ids.groupBy("f", "raw").agg(F.count("*").alias("n"))
    links = sizes.join(sizes.groupBy("f").agg(F.sum("n").alias("all")), "f").select("f", "raw", (F.col("all") - F.col("n")).alias("links"))
    return ids.join(links, ["f", "raw"]).select(F.col("k").alias(key), F.col("f").alias("form_class"), F.col("raw").alias("text_class"), "links")


def alike(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_a, doc_b), a < b: texts that have the same form but aren't the same string.

    Texts are first grouped into classes of equal strings; classes of one form are paired, then their members, so a
    large class of exact copies is never compared with itself. Null texts pair with nothing.
    """
    raw = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.md5(F.col(text).cast("binary")).alias("raw"))
    forms = consistent_forms(docs, key, text).filter("form is not null").select(F.col(key).alias("k"), F.md5(F.col("form").cast("binary")).alias("f"))
    ids = materialize(raw.join(forms, "k"), "forms")
    classes = ids.select("f", "raw").distinct()
    several = classes.groupBy("f").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).filter("lo < hi").select("f")
    left = classes.join(several, "f", "left_semi")
    pairs = left.select("f", F.col("raw").alias("raw_a")).join(left.select("f", F.col("raw").alias("raw_b")), "f").filter("raw_a < raw_b")
    one = ids.select("f", F.col("raw").alias("raw_a"), F.col("k").alias("a"))
    two = ids.select("f", F.col("raw").alias("raw_b"), F.col("k").alias("b"))
    both = pairs.join(one, ["f", "raw_a"]).join(two, ["f", "raw_b"])
    return both.select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).filter("doc_a < doc_b").distinct()
