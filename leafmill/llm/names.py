"""Linking the spellings of one person or organisation.

Distinct spellings become idf-weighted vectors of character n-grams. A distributed similarity join over an inverted index of
n-grams finds every pair over the cosine threshold: vectors are of length one, so a pair that reaches it must share one
of the rarest n-grams that hold all but the threshold of either vector's length. Pairs are then scored by their parts
(surnames, given names, initials, legal forms), and average-linkage clustering joins them: clusters that are each
other's nearest merge, round by round, which gives the same clusters as merging the single nearest pair each time.
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

COSINE = 0.4
LINK = 0.5

#: Short forms of given names are learned from surnames that two given names share: where so many surnames have both beyond
#: a multiple of what chance gives, and this share of those of the rarer one have the other. A surname of more than SHARED
#: given names counts for SHARED over their number, since sharing it says the less.
SHARED, SUPPORT, CHANCE, TOGETHER = 12, 2, 6.0, 0.25
#: Words of up to so many letters also meet by what is left when a letter is taken out, since a change of one letter leaves them
#: hardly an n-gram in common.
SHORT = 8
TITLES = set("prof professor dr doctor mr mrs ms miss sir dame hon rev md phd msc bsc mba dphil dsc jr sr ii iii iv esq frcp pharmd rn mph frs dvm mphil ing dipl habil med univ".split())
# Legal forms and their long forms.
LEGAL = set("inc incorporated ltd limited llc llp lp plc corp corporation co company gmbh ag aktiengesellschaft sa societe anonyme bv nv ab as oy kk kg kgaa se spa srl sarl pty pte aps holding cokg pvt".split())
_LEGAL_LONG = re.compile(r"\b(gesellschaft mit beschrankter haftung|societe anonyme|public limited company|besloten vennootschap|naamloze vennootschap|company limited|limited liability company)\b")
# Lines of business with their short forms, the full word first.
BUSINESS = """
pharmaceuticals pharma pharm pharmaceut pharmaceutical phar
therapeutics tx thera ther therap therapeutic
biosciences bio biosci bioscience biosc
neurosciences neuro neurosci neuroscience
laboratories lab labs laboratory labor
medicines med meds medicine medic
diagnostics dx diag diagn diagnostic
genomics gx genom genomic gen
oncology onc oncol onco
biologics blx biol biologic biologicals
biotechnology biotech biotechnologies
technologies tech technology
sciences sci science
holdings hldgs holding hldg
healthcare health
"""
_ALIASES = {short: line.split()[0] for line in BUSINESS.strip().split("\n") for short in line.split()}
_FULL = sorted(set(_ALIASES.values()))
Nicknames = dict[str, set[str]]
_PLAIN = str.maketrans({"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "ð": "d", "ı": "i", "’": "'", "`": "'"})


def folded(name: str) -> str:
    """Without accents, case and width kept apart only by letters: 'Vigdís' -> 'Vigdis'."""
    s = unicodedata.normalize("NFKD", name.translate(_PLAIN))
    return "".join(c for c in s if not unicodedata.combining(c))


@lru_cache(maxsize=1 << 18)
def edits(a: str, b: str, most: int = 2) -> int:
    """Edits between two words (a swap of neighbours is one), or ``most`` + 1 when there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, last = last, now
    return min(last[-1], most + 1)


@lru_cache(maxsize=1 << 16)
def person(name: str) -> tuple[tuple[str, ...], tuple[str, ...], int]:
    """(long words, initials, place of the surname among the long words or -1) of a person's name."""
    s = folded(name).strip()
    s = re.sub(r"\bet\s+al\b\.?", " ", s)
    parts = [p.strip() for p in s.split(",")]
    parts = [p for p in parts if p and not all(w.strip(".").replace(".", "").lower() in TITLES for w in p.split())]
    inverted = len(parts) > 1
    raw = " ".join(parts[1:] + parts[:1]) if inverted else (parts[0] if parts else "")
    words, initials = [], []
    mixed = any(c.islower() for c in raw)
    for w in re.split(r"[\s]+", raw):
        bare = w.strip(".'\"()")
        # 'MD Miller' holds initials, 'Ann Miller MD' a degree.
        glued = bare == "MD" and not words and not initials and len(raw.split()) == 2
        if not bare or bare.replace(".", "").lower() in TITLES and not glued:
            continue
        if re.fullmatch(r"(?:[A-Za-z]\.)+[A-Za-z]?\.?", w) or len(bare) == 1 or (mixed and bare.isupper() and len(bare) <= 3):
            initials += [c.lower() for c in bare if c.isalpha()]
        else:
            words.append("".join(c for c in bare.lower() if c.isalpha()))
    words = [w for w in words if w]
    place = len(words) - 1 if inverted and words else -1
    return tuple(words), tuple(initials), place


def _given_alike(a: str, b: str, nick: Nicknames) -> float:
    if a == b:
        return 1.0
    if b in nick.get(a, ()):
        return 0.95
    n, short = max(len(a), len(b)), min(len(a), len(b))
    d = edits(a, b)
    if d <= (1 if n < 8 else 2) and n > 3:
        return 0.9
    # The beginning of a name is its short form in most languages, with a vowel or two after it in many.
    if short > 2 and (a.startswith(b) or b.startswith(a)):
        return 0.9
    stem = 0
    while stem < short and a[stem] == b[stem]:
        stem += 1
    if stem > 2 and stem >= short - 2 and n > short:
        return 0.8
    # A short form of one and a misspelling of the other.
    if any(len(y) > 4 and edits(f, y) <= (1 if len(f) < 8 else 2) for x, y in ((a, b), (b, a)) for f in nick.get(x, ())):
        return 0.8
    # Short forms of one name.
    if nick.get(a, set()) & nick.get(b, set()):
        return 0.8
    # Too little to link two names, but no conflict inside a group of spellings.
    return 0.45 if d == 2 and n > 4 else 0.0


def _surname_alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    d = edits(a, b)
    return 0.92 if d == 1 and n > 4 else 0.7 if d == 2 and n > 8 else 0.0


def _firsts(given: str, nick: Nicknames) -> set[str]:
    """First letters that a given name or an initial can stand for: its own and those of the names it goes with."""
    return {given[0], *(full[0] for full in nick.get(given, ()) if len(given) > 1)}


def _initials_fit(given: list[str], initials_a: list[str], other: list[str], initials_b: list[str], nick: Nicknames) -> float:
    """1 when both sides' given parts can be the same sequence, less when parts are missing, 0 on a conflict."""
    one = [*given, *initials_a]
    two = [*other, *initials_b]
    if not one or not two:
        return 0.6
    score = 1.0
    for i, (x, y) in enumerate(zip(one, two)):
        if len(x) > 1 and len(y) > 1:
            s = _given_alike(x, y, nick)
        elif _firsts(x, nick) & _firsts(y, nick):
            s = 0.9 if i else 0.8
        else:
            s = 0.0
        if not s:
            return 0.0
        score = min(score, s)
    return score if len(one) == len(two) else score * 0.97


def person_score(a: str, b: str, nick: Nicknames = {}) -> float:  # noqa: B006
    """How surely two names are spellings of one person's name: 0 to 1."""
    wa, ia, pa = person(a)
    wb, ib, pb = person(b)
    best = 0.0
    for i, x in enumerate(wa):
        if pa not in (-1, i):
            continue
        for j, y in enumerate(wb):
            if pb not in (-1, j):
                continue
            surname = _surname_alike(x, y)
            if not surname:
                continue
            ga = [w for k, w in enumerate(wa) if k != i]
            gb = [w for k, w in enumerate(wb) if k != j]
            if not ga and not ia or not gb and not ib:
                fit = 0.5
            else:
                fit = _initials_fit(ga, list(ia), gb, list(ib), nick)
            # The surname is taken to stand last, or first; a given name in its place makes the match less sure.
            usual = 1.0 if (i == len(wa) - 1 and j == len(wb) - 1) else 0.98
            if surname < 1 and fit < 0.85 and not (len(x) > 6):
                fit *= 0.8
            best = max(best, surname * fit * usual)
    return best


@lru_cache(maxsize=1 << 16)
def company(name: str) -> tuple[tuple[str, ...], str]:
    """(stem words, line of business or '') of a firm's name."""
    s = folded(name)
    s = re.sub(r"\([^)]*\)", " ", s)
    s = re.sub(r"(?<=[a-z]{4})(?=[A-Z][a-z]{3})", " ", s).lower()
    s = re.sub(r"\b([a-z])\.\s?(?=[a-z]\b)", r"\1", s)
    s = _LEGAL_LONG.sub(" ", s)
    words = [w for w in re.split(r"[^a-z0-9]+", s) if w]
    if len(words) > 2 and words[0] == "the" and words[-1] == "company":
        words = words[1:-1]
    while len(words) > 1 and words[-1] in LEGAL:
        words = words[:-1]
    words = [w for w in words if w not in ("and", "und", "et", "y", "the", "e")] or words
    line, stem = "", []
    for w in words:
        full = _ALIASES.get(w) or (next((f for f in _FULL if f.startswith(w)), None) if len(w) >= 4 else None)
        if not full and len(w) >= 6:
            full = next((f for f in _FULL if abs(len(f) - len(w)) <= 2 and edits(w, f) <= 2), None)
        if full and not line and len(words) > 1:
            line = full
        else:
            stem.append(w)
    if len(stem) == 1 and not line:
        for f in _FULL:
            if stem[0].endswith(f) and len(stem[0]) > len(f) + 3:
                return (stem[0][: -len(f)],), f
    return tuple(stem), line


def company_score(a: str, b: str, nick: Nicknames = {}) -> float:  # noqa: B006
    """How surely two names are spellings of one firm's name: 0 to 1."""
    sa, la = company(a)
    sb, lb = company(b)
    if la and lb and la != lb:
        return 0.0
    business = 1.0 if la == lb and la else 0.9 if la or lb else 0.95
    one, two = "".join(sa), "".join(sb)
    if not one or not two:
        return 0.0
    if one == two:
        return business
    if len(sa) == len(sb) and sorted(sa) == sorted(sb):
        return business * 0.98
    for x, y in ((sa, two), (sb, one)):
        if len(x) == 2 and edits(x[1] + x[0], y, 1) <= 1:
            return business * 0.95
    n = max(len(one), len(two))
    d = edits(one, two)
    stem = 0.9 if d == 1 and n > 4 else 0.65 if d == 2 and n > 8 else 0.0
    if not stem and len(sa) == len(sb) > 1:
        alike = [_surname_alike(x, y) or (0.85 if min(len(x), len(y)) == 1 and x[0] == y[0] else 0.0) for x, y in zip(sorted(sa), sorted(sb))]
        swapped = [_surname_alike(x, y) or (0.85 if min(len(x), len(y)) == 1 and x[0] == y[0] else 0.0) for x, y in zip(sa, reversed(sb))]
        straight = [_surname_alike(x, y) or (0.85 if min(len(x), len(y)) == 1 and x[0] == y[0] else 0.0) for x, y in zip(sa, sb)]
        stem = max(min(alike), min(swapped), min(straight))
        if max(len(w) for w in sa) == 1 or max(len(w) for w in sb) == 1:
            stem = 0.0
    return stem * business


SCORES = {"author": person_score, "company": company_score}


def _grams(word: str) -> set[str]:
    """Bordered n-grams: of 3 characters, and of 4 characters in sorted order, which a swap of neighbours hardly changes."""
    p = f"^{word}$"
    return {p[i : i + 3] for i in range(max(1, len(p) - 2))} | {"~" + "".join(sorted(p[i : i + 4])) for i in range(max(1, len(p) - 3))}


def features(kind: str, name: str, nick: Nicknames = {}) -> list[set[str]]:  # noqa: B006
    """The n-gram sets of a spelling, one per reading.

    A firm has one: the n-grams of its stem words and of the words run together. A person has one per word that can be
    the surname (the last, or the first where the order isn't marked); its n-grams carry the initials that the rest of
    the name can stand for, since only spellings with a common initial can be one person. A name that is one bare word
    has a reading without initials and meets only its like.
    """
    if kind != "author":
        words = company(name)[0]
        return [set().union(*map(_grams, words), _grams("".join(words)))] if words else []
    words, initials, place = person(name)
    if not words:
        return []
    out = []
    for i in dict.fromkeys((len(words) - 1, 0) if place < 0 else (place,)):
        rest = [w for k, w in enumerate(words) if k != i]
        first = _firsts(rest[0], nick) if rest else {initials[0]} if initials else {""}
        out += [{f + g for g in _grams(words[i])} for f in sorted(first)]
    return out


def stumps(kind: str, name: str, nick: Nicknames) -> set[str]:
    """What is left of short surnames and stems, whole and with any one letter taken out, with the initials of the rest."""
    if kind != "author":
        word = "".join(company(name)[0])
        heads = [("", word)] if word else []
    else:
        words, initials, place = person(name)
        heads = []
        for i in dict.fromkeys((len(words) - 1, 0) if place < 0 else (place,)) if words else ():
            rest = [w for k, w in enumerate(words) if k != i]
            heads += [(f, words[i]) for f in (_firsts(rest[0], nick) if rest else {initials[0]} if initials else {""})]
    return {f"{f} {w[:i]}{w[i + 1 :]}" for f, w in heads if len(w) <= SHORT for i in range(len(w) + 1)}


def _given_and_surname(spellings: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, n in zip(b["kind"], b["name"]):
                words, _, place = person(n) if k == "author" and n else ((), (), 0)
                if len(words) > 1:
                    rows.append((words[place], words[0]))
            yield pd.DataFrame(rows, columns=["surname", "given"])

    return spellings.mapInPandas(run, "surname string, given string").distinct()


def learned(spellings: DataFrame) -> DataFrame:
    """(given, others): given names that go with one surname again and again, each with the names it is used for.

    Two given names of one person stand under one surname in many spellings, those of different people only by chance.
    What is shared is summed by the weights of the surnames, so a given name whose surnames sum to less than SUPPORT can't
    have a partner; all others meet under each of their surnames.
    """
    held = materialize(_given_and_surname(spellings), "given-names")
    weights = held.groupBy("surname").agg(F.count("*").alias("n")).filter("n > 1").select("surname", F.least(F.lit(1.0), SHARED / F.col("n")).alias("w"))
    of = materialize(held.join(weights, "surname"), "weighted-names")
    total = float(weights.agg(F.sum("w")).first()[0] or 1.0)
    count = of.groupBy("given").agg(F.sum("w").alias("c")).filter(F.col("c") >= SUPPORT - 1e-9)
    count = materialize(count, "given-counts")
    able = of.join(count.select("given"), "given", "left_semi")
    two = able.join(able.select("surname", F.col("given").alias("other")), "surname").filter("given < other").groupBy("given", "other").agg(F.sum("w").alias("n")).filter(F.col("n") >= SUPPORT - 1e-9)
    # Sums of weights differ in their last digits by the order of the rows.
    judged = two.join(count, "given").join(count.select(F.col("given").alias("other"), F.col("c").alias("d")), "other").filter((F.col("n") >= TOGETHER * F.least("c", "d") - 1e-9) & (F.col("n") >= SUPPORT + CHANCE * F.col("c") * F.col("d") / total - 1e-9))
    both = judged.select("given", "other").unionByName(judged.select(F.col("other").alias("given"), F.col("given").alias("other")))
    return materialize(both.groupBy("given").agg(F.sort_array(F.collect_list("other")).alias("others")), "learned")


def nicknames(spellings: DataFrame) -> Nicknames:
    """What ``learned`` finds, on the driver: for tables that are known to be small."""
    return {r.given: set(r.others) for r in learned(spellings).collect()}


def _known(spellings: DataFrame, nick: DataFrame) -> DataFrame:
    """(kind, name, nick): the spellings that hold words of ``nick``, with their entries, so that no task needs all of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, n, w) for k, n in zip(b["kind"], b["name"]) if k == "author" for w in set(person(n)[0])]
            yield pd.DataFrame(rows, columns=["kind", "name", "given"])

    words = spellings.select("kind", "name").mapInPandas(run, "kind string, name string, given string")
    return materialize(words.join(nick, "given").groupBy("kind", "name").agg(F.collect_list(F.struct("given", "others")).alias("nick")), "known")


def _entries(*columns) -> Nicknames:
    return {x["given"]: set(x["others"]) for c in columns if c is not None for x in c}


def _reaches(common: Column, el: Column, least: Column) -> Column:
    """Whether ``el`` is the first of the common elements and their squared weights sum to ``least``."""
    # A null marks another first element, so that the array is made once.
    dot = F.aggregate(common, F.lit(0).cast("long"), lambda s, x: F.when((s == 0) & (x != el), F.lit(None)).otherwise(s + x.bitwiseAND(F.lit(65535))))
    return F.coalesce(dot >= least, F.lit(False))


def similar_pairs(spellings: DataFrame, cosine: float = COSINE, nick: DataFrame | None = None) -> DataFrame:
    """(kind, a, b, score), a < b: every two spellings of a kind with a reading each whose cosine reaches ``cosine`` and
    whose parts agree. No number of partners is set: all that reach the threshold are kept.

    In the index an n-gram is a long: its hash with its squared weight in the low 16 bits, so the dot product of two
    vectors is the sum of the low bits of their common elements. Short words also meet by their stumps. ``nick`` holds
    the short forms of given names, as ``learned`` gives them.
    """
    nothing = F.lit(None).cast("array<struct<given: string, others: array<string>>>").alias("nick")
    known = _known(spellings, nick) if nick is not None else spellings.select("kind", "name", nothing).limit(0)
    told = materialize(spellings.select("kind", "name").join(known, ["kind", "name"], "left"), "told")

    def readings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, n, i, sorted(g)) for k, n, x in zip(b["kind"], b["name"], b["nick"]) for i, g in enumerate(features(k, n, _entries(x)))]
            yield pd.DataFrame(rows, columns=["kind", "name", "reading", "grams"])

    read = materialize(told.mapInPandas(readings, "kind string, name string, reading int, grams array<string>"), "readings")
    rows = read.select("kind", "name", "reading", F.explode("grams").alias("gram"))
    frequency = rows.groupBy("kind", "gram").agg(F.count("*").alias("df"))
    total = read.groupBy("kind").agg(F.count("*").alias("n"))
    square = F.least(F.lit(65535), F.greatest(F.lit(1), F.round(F.log(1 + F.col("n") / F.col("df")) ** 2 * 100))).cast("long")
    weighted = rows.join(frequency, ["kind", "gram"]).join(total, "kind").withColumn("sq", square).withColumn("el", F.shiftleft(F.xxhash64("kind", "gram"), 16).bitwiseOR(F.col("sq")))
    vectors = weighted.groupBy("kind", "name", "reading").agg(F.sort_array(F.collect_list(F.struct("df", "el", "sq"))).alias("v"), F.sum("sq").alias("norm"))
    before = F.transform("v", lambda x, i: F.struct(x.el.alias("el"), F.aggregate(F.slice("v", F.lit(1), i), F.lit(0).cast("long"), lambda s, y: s + y.sq).alias("before")))
    prefix = F.filter(before, lambda x: x.before <= (1 - cosine * cosine) * F.col("norm"))
    els = F.transform("v", lambda x: x.el)
    # 128 bits in two longs, one by the hash of each n-gram.
    bits = [F.aggregate(els, F.lit(0).cast("long"), lambda s, x: s.bitwiseOR(F.call_function("shiftleft", F.when(F.call_function("shiftright", x, F.lit(22)).bitwiseAND(F.lit(1)) == half, F.lit(1)).otherwise(F.lit(0)).cast("long"), F.call_function("shiftright", x, F.lit(16)).bitwiseAND(F.lit(63)).cast("int")))) for half in (0, 1)]  # noqa: B023
    vectors = vectors.select("kind", "name", els.alias("els"), "norm", prefix.alias("p"), bits[0].alias("low"), bits[1].alias("high"), F.monotonically_increasing_id().alias("id"))
    vectors = materialize(vectors, "vectors")
    kept = vectors.select("id", "norm", "low", "high", F.size("els").alias("n"), F.explode("p").alias("p"))
    index = kept.select("id", F.sqrt("norm").alias("length"), "low", "high", "n", F.col("p.el").alias("el"), F.sqrt(F.col("norm") - F.col("p.before")).alias("left"))
    left, right = (index.select("el", *[F.col(c).alias(f"{c}_{end}") for c in ("id", "length", "low", "high", "n", "left")]) for end in "ab")
    # All that two vectors share lies at or after their rarest common element, where the parts that are left bound the product:
    # a pair is judged at that element only, and not where the bound is too low. No later element weighs more, and
    # an n-gram whose bit the other vector lacks isn't shared, which bounds it too; only what passes meets the n-grams themselves.
    lacks = lambda x, y: sum(F.bit_count(F.col(f"{c}_{x}").bitwiseAND(F.bitwise_not(f"{c}_{y}"))) for c in ("low", "high"))
    shared = F.least(F.col("n_a") - lacks("a", "b"), F.col("n_b") - lacks("b", "a"))
    least = cosine * F.col("length_a") * F.col("length_b") * (1 - 1e-9)
    # Spark takes a generator's rows for as few as those it reads, so the size of the index is no reason to send it to all tasks.
    near = left.join(right.hint("merge"), "el").filter((F.col("id_a") < F.col("id_b")) & (F.col("left_a") * F.col("left_b") >= least) & (shared * F.col("el").bitwiseAND(F.lit(65535)) >= least)).select("el", "id_a", "id_b")
    ends = [vectors.select(F.col("id").alias(f"id_{end}"), "kind" if end == "a" else F.lit(0).alias("other"), F.col("name").alias(end), F.col("els").alias(f"e{end}"), F.sqrt("norm").alias(f"n{end}")) for end in "ab"]
    near = near.hint("merge").join(ends[0], "id_a").hint("merge").join(ends[1], "id_b").filter(F.col("a") != F.col("b"))
    close = near.filter(_reaches(F.array_intersect("ea", "eb"), F.col("el"), cosine * F.col("na") * F.col("nb"))).select("kind", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, n, s) for k, n, x in zip(b["kind"], b["name"], b["nick"]) for s in stumps(k, n, _entries(x))]
            yield pd.DataFrame(rows, columns=["kind", "name", "stump"])

    stumped = materialize(told.mapInPandas(cut, "kind string, name string, stump string"), "stumps")
    short = stumped.withColumnRenamed("name", "a").join(stumped.withColumnRenamed("name", "b"), ["kind", "stump"]).filter("a < b").select("kind", "a", "b")
    close = close.unionByName(short).distinct()
    for end in ("a", "b"):
        close = close.join(known.select("kind", F.col("name").alias(end), F.col("nick").alias(f"nick_{end}")), ["kind", end], "left")
    close = spread(close)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["score"] = [SCORES[k](x, y, _entries(u, v)) for k, x, y, u, v in zip(b["kind"], b["a"], b["b"], b["nick_a"], b["nick_b"])]
            yield b[b["score"] > 0][["kind", "a", "b", "score"]]

    return close.mapInPandas(judge, "kind string, a string, b string, score double")


def average_linkage(spellings: DataFrame, pairs: DataFrame, link: float = LINK) -> DataFrame:
    """(kind, name, cluster): clusters by average linkage; a pair that isn't in ``pairs`` counts as 0.

    Each round merges the clusters that are each other's nearest over ``link``; it ends when there are none. Ties go to
    the larger summed score, then to the lower name.
    """
    members = materialize(spellings.select("kind", "name", F.col("name").alias("cluster")), "members")
    edges = pairs.select("kind", F.col("a").alias("x"), F.col("b").alias("y"), F.col("score").alias("s"), F.lit(1).alias("nx"), F.lit(1).alias("ny"))
    edges = materialize(edges.unionByName(edges.select("kind", F.col("y").alias("x"), F.col("x").alias("y"), "s", "nx", "ny")), "edges")
    while True:
        near = edges.withColumn("mean", F.col("s") / (F.col("nx") * F.col("ny"))).filter(F.col("mean") >= link)
        lo, hi = F.least("x", "y"), F.greatest("x", "y")
        # The order must be the same from both ends of an edge, or two clusters may each wait for the other.
        best = near.groupBy("kind", "x").agg(F.max_by("y", F.struct(F.round("mean", 9), F.col("nx") + F.col("ny"), F.hash(lo, hi), lo, hi)).alias("y"))
        mutual = best.alias("p").join(best.alias("q"), (F.col("p.kind") == F.col("q.kind")) & (F.col("p.x") == F.col("q.y")) & (F.col("p.y") == F.col("q.x"))).filter("p.x < p.y")
        merged = materialize(mutual.select(F.col("p.kind").alias("kind"), F.col("p.y").alias("old"), F.col("p.x").alias("new")), "merged")
        if merged.isEmpty():
            return members
        members = materialize(members.join(merged.withColumnRenamed("old", "cluster"), ["kind", "cluster"], "left").select("kind", "name", F.coalesce("new", "cluster").alias("cluster")), "members")
        moved = edges.join(merged.select("kind", F.col("old").alias("x"), F.col("new").alias("to_x")), ["kind", "x"], "left").join(merged.select("kind", F.col("old").alias("y"), F.col("new").alias("to_y")), ["kind", "y"], "left")
        moved = moved.select("kind", F.coalesce("to_x", "x").alias("x"), F.coalesce("to_y", "y").alias("y"), "s").filter("x <> y").groupBy("kind", "x", "y").agg(F.sum("s").alias("s"))
        sizes = members.groupBy("kind", "cluster").agg(F.count("*").alias("size"))
        edges = materialize(moved.join(sizes.select("kind", F.col("cluster").alias("x"), F.col("size").alias("nx")), ["kind", "x"]).join(sizes.select("kind", F.col("cluster").alias("y"), F.col("size").alias("ny")), ["kind", "y"]), "edges")


def linked(mentions: DataFrame) -> DataFrame:
    """(kind, name, cluster) of every distinct non-empty spelling in ``mentions`` (kind, name).

    Null and blank names are left out; repeated mentions count once; an empty table gives no rows; very long names are
    taken whole.
    """
    spellings = materialize(mentions.filter(F.trim("name") != "").select("kind", "name").distinct(), "spellings")
    return average_linkage(spellings, materialize(similar_pairs(spellings, nick=learned(spellings)), "pairs"))


def linked_pairs(mentions: DataFrame) -> DataFrame:
    """(kind, name_a, name_b), a < b: every two spellings of one cluster; clusters hold distinct spellings only."""
    clusters = linked(mentions)
    a = clusters.select("kind", "cluster", F.col("name").alias("name_a"))
    b = clusters.select("kind", "cluster", F.col("name").alias("name_b"))
    return a.join(b, ["kind", "cluster"]).filter("name_a < name_b").select("kind", "name_a", "name_b")
