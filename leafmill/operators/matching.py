"""Joins and lookups. Every join names its keys; sides are broadcast by Spark only where their size is known to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import text as X

# Other names of companies, in lower case, and the name to use.
COMPANY_ALIASES = {
    "az": "AstraZeneca", "astra zeneca": "AstraZeneca", "astrazeneca": "AstraZeneca", "daiichi-sankyo": "Daiichi Sankyo", "daiichisankyo": "Daiichi Sankyo",
    "daiichi sankyo": "Daiichi Sankyo", "bms": "Bristol-Myers Squibb", "bristol myers squibb": "Bristol-Myers Squibb", "bristol-myers squibb": "Bristol-Myers Squibb",
    "roche/genentech": "Roche", "genentech": "Roche", "msd": "Merck & Co.", "merck & co": "Merck & Co.", "merck & co.": "Merck & Co.", "lilly": "Eli Lilly",
    "eli lilly": "Eli Lilly", "j&j": "Johnson & Johnson", "janssen": "Johnson & Johnson", "pfizer inc": "Pfizer", "pfizer inc.": "Pfizer", "gsk": "GlaxoSmithKline",
    "glaxo smith kline": "GlaxoSmithKline", "glaxosmithkline": "GlaxoSmithKline", "sanofi-aventis": "Sanofi", "abbvie": "AbbVie", "seagen": "Pfizer",
}
ASSET_CODE = r"(?i)^[A-Z]{1,5}-?\d{2,}"


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first in the order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def lookup(left: DataFrame, right: DataFrame, key: str, alternatives: list[str], value: list[str], order: Column) -> DataFrame:
    """Left join on the first of several key columns of the right side that holds the key; of equal ones the first row.

    Null keys match nothing; a left row is returned once.
    """
    keyed = right.select(*value, order.alias("__o"), F.posexplode(F.array(*[F.col(a).cast("string") for a in alternatives])).alias("__p", key)).filter(F.col(key).isNotNull())
    return left.join(first_by(keyed, [key], F.col("__p"), F.col("__o")).drop("__o", "__p"), key, "left")


def canonical_company(c: Column) -> Column:
    """The usual name of a company, by the alias list, else the trimmed name."""
    alias = F.create_map(*[F.lit(x) for pair in COMPANY_ALIASES.items() for x in pair])
    return F.coalesce(F.element_at(alias, F.lower(X.strip(c))), X.strip(c))


def unique_containment(left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_id: str, right_text: str, least: int = 10) -> DataFrame:
    """(left_id, right_id) where exactly one right text contains, or is contained in, the left text, case apart.

    Every run of ``run`` characters of the contained text is one of the other, its rarest run included, so the pairs come
    from an equi-join on runs and not from a product; the text may begin and end inside a word. Of ``span`` runs in a row
    the one of the lowest hash is enough, on either side; a text with one that no text of the other side has is contained in none.
    Equal texts are compared once. Texts under ``least`` characters, which is no less than ``run``, take no part.
    """
    from leafmill.session import materialize

    run = min(8, least)
    span = min(3, least - run + 1)

    def texts(rows: DataFrame, key: str, text: str) -> DataFrame:
        some = rows.select(F.col(key).alias("id"), F.lower(text).alias("t")).filter(F.length("t") >= least)
        some = some.groupBy("t").agg(F.collect_list(F.struct("id")).alias("ids")).withColumn("s", F.monotonically_increasing_id())
        h = F.transform(F.sequence(F.lit(1), F.length("t") - run + 1), lambda i: F.xxhash64(F.substring(F.col("t"), i, F.lit(run))))
        some = some.withColumn("h", h).withColumn("ws", F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("h") - span + 1), lambda i: F.array_min(F.slice("h", i, span)))))
        return materialize(some.drop("h"), "texts")

    def rarest(runs: DataFrame, other: DataFrame) -> DataFrame:
        """(s, w): of each text the run that the fewest texts of the other side have, where they have all of its runs."""
        seen = runs.join(other.groupBy("w").agg(F.count("*").alias("n")).hint("merge"), "w", "left").groupBy("s").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "w")).alias("m"))
        return seen.filter("m.n > 0").select("s", "m.w")

    # Spark takes a generator's rows for as few as those it reads, so the size of a side with one is no reason to send it to all tasks.
    a, b = texts(left, left_id, left_text), texts(right, right_id, right_text)
    ra, rb = a.select("s", F.explode("ws").alias("w")), b.select("s", F.explode("ws").alias("w"))
    inside = rarest(ra, rb).select(F.col("s").alias("a"), "w").join(rb.select(F.col("s").alias("b"), "w").hint("merge"), "w").select("a", "b")
    around = rarest(rb, ra).select(F.col("s").alias("b"), "w").join(ra.select(F.col("s").alias("a"), "w").hint("merge"), "w").select("a", "b")
    near = inside.union(around).distinct()
    ta, tb = a.select(F.col("s").alias("a"), F.col("t").alias("ta")), b.select(F.col("s").alias("b"), F.col("t").alias("tb"), F.size("ids").alias("n"), F.array_min("ids").getField("id").alias("id"))
    pairs = near.hint("merge").join(ta, "a").hint("merge").join(tb, "b").filter(F.col("ta").contains(F.col("tb")) | F.col("tb").contains(F.col("ta")))
    once = pairs.groupBy("a").agg(F.sum("n").alias("n"), F.min("id").alias("b"))
    found = once.hint("merge").join(a.select(F.col("s").alias("a"), F.explode("ids.id").alias("id")), "a")
    # A repeated left id counts with all its texts.
    return found.groupBy("id").agg(F.sum("n").alias("n"), F.min("b").alias("b")).filter("n = 1").select(F.col("id").alias(left_id), F.col("b").alias(right_id))


def best_by_words(left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_id: str, right_text: str, longer_than: int = 3, least: int = 2) -> DataFrame:
    """(left_id, right_id, score): the right row that holds most of the left row's words (repeats count); the first id of
    equal ones; under ``least`` none.

    Right rows of the same words count as one, the first of them. Words that all of them hold tell none apart: they are
    added to the scores without a join.
    """
    words = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: F.length(w) > longer_than)
    a = left.select(F.col(left_id).alias("a"), F.explode(words(F.col(left_text))).alias("w")).groupBy("a", "w").agg(F.count("*").alias("n"))
    sets = right.select(F.col(right_id).alias("b"), F.array_sort(F.array_distinct(words(F.col(right_text)))).alias("ws")).groupBy("ws").agg(F.min("b").alias("b"))
    size = sets.agg(F.count("*").alias("n"), F.min("b").alias("first")).first()
    held = sets.select("b", F.explode("ws").alias("w"))
    everywhere = held.groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") == size.n).select("w")
    shared = a.join(everywhere, "w").groupBy("a").agg(F.sum("n").alias("shared"))
    apart = a.join(held.join(everywhere, "w", "left_anti"), "w").groupBy("a", "b").agg(F.sum("n").alias("s"))
    alone = shared.select("a", F.lit(size.first).cast(sets.schema["b"].dataType).alias("b"), F.lit(0).cast("long").alias("s"))
    score = apart.unionByName(alone).join(shared, "a", "left").select("a", "b", (F.col("s") + F.coalesce("shared", F.lit(0))).alias("score")).filter(F.col("score") >= least)
    return first_by(score, ["a"], F.desc("score"), F.col("b")).select(F.col("a").alias(left_id), F.col("b").alias(right_id), "score")


#: Token sets of up to so many tokens meet by pairs of tokens, for every two sizes; longer ones by single tokens.
SHORT_SET = 40


def similar_titles(left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_id: str, right_text: str, least: float) -> DataFrame:
    """(left_id, right_id, common, total) of every pair whose token sets reach a Jaccard similarity of ``least``.

    Exact filters: sets of m and n tokens must have c = least / (1 + least) * (m + n) in common, so they share two of the
    rarest m - c + 2 and n - c + 2 tokens; those pairs, with both sizes, are indexed and joined. A set carries 64 bits,
    one by the hash of each token: two sets differ in at least as many tokens as bits. Equal sets are compared once.
    """
    from leafmill.session import materialize

    def sets(rows: DataFrame, key: str, text: str) -> DataFrame:
        some = rows.select(F.col(key).alias("id"), F.array_sort(X.tokens(F.col(text))).alias("t")).filter(F.size("t") > 0)
        return materialize(some.groupBy("t").agg(F.collect_list(F.struct("id")).alias("ids")).withColumn("s", F.monotonically_increasing_id()), "sets")

    a, b = sets(left, left_id, left_text), sets(right, right_id, right_text)
    df = a.select(F.explode("t").alias("w")).union(b.select(F.explode("t").alias("w"))).groupBy("w").count()
    need = lambda m, n: F.ceil(least / (1 + least) * (m + n) - 1e-9).cast("int")

    def index(rows: DataFrame, side: str) -> DataFrame:
        """(k, s, m, bits) with the set's number and size under names of the side: a row per key that a set can be met by."""
        ranked = rows.select("s", F.explode("t").alias("w")).join(df.hint("merge"), "w").groupBy("s").agg(F.sort_array(F.collect_list(F.struct("count", "w"))).alias("r"))
        ranked = ranked.select("s", F.transform("r", lambda x: x.w).alias("r"), F.size("r").alias("m"))
        ranked = ranked.withColumn("bits", F.aggregate("r", F.lit(0).cast("long"), lambda x, w: x.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(w), F.lit(64))))))
        low, high = F.ceil(F.col("m") * least - 1e-9).cast("int"), F.least(F.lit(SHORT_SET), F.floor(F.col("m") / least + 1e-9)).cast("int")
        short = ranked.filter(F.col("m") <= SHORT_SET).withColumn("n", F.explode(F.sequence(F.greatest(F.lit(1), low), high))).withColumn("c", need(F.col("m"), F.col("n")))
        sizes = ("m", "n") if side == "a" else ("n", "m")
        short = short.withColumn("p", F.slice("r", F.lit(1), F.col("m") - F.col("c") + F.least(F.lit(2), F.col("c"))))
        two = F.flatten(F.transform("p", lambda x, i: F.transform(F.slice("p", i + 2, F.size("p")), lambda y: F.xxhash64(x, y, *sizes))))
        one = F.transform("p", lambda x: F.xxhash64(x, *sizes))
        short = short.select(F.explode(F.when(F.col("c") > 1, two).otherwise(one)).alias("k"), "s", "m", "bits")
        long = ranked.filter(F.floor(F.col("m") / least + 1e-9) > SHORT_SET)
        long = long.select(F.explode(F.transform(F.slice("r", F.lit(1), (F.col("m") - F.ceil(F.col("m") * least - 1e-9) + 1).cast("int")), lambda x: F.xxhash64(x))).alias("k"), "s", "m", "bits")
        return short.union(long).select("k", F.col("s").alias(side), F.col("m").alias(f"m{side}"), F.col("bits").alias(f"bits_{side}"))

    # Spark takes a generator's rows for as few as those it reads, so the size of a side with one is no reason to send it to all tasks.
    near = index(a, "a").join(index(b, "b").hint("merge"), "k")
    near = near.filter(F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= F.col("ma") + F.col("mb") - 2 * need(F.col("ma"), F.col("mb"))).select("a", "b").distinct()
    ta, tb = a.select(F.col("s").alias("a"), F.col("t").alias("ta"), F.col("ids").alias("as")), b.select(F.col("s").alias("b"), F.col("t").alias("tb"), F.col("ids").alias("bs"))
    sized = near.hint("merge").join(ta, "a").hint("merge").join(tb, "b").withColumn("common", F.size(F.array_intersect("ta", "tb")).cast("long")).withColumn("total", F.size("ta") + F.size("tb") - F.col("common"))
    found = sized.filter(F.col("common") >= least * F.col("total")).select(F.explode("as.id").alias("a"), "bs", "common", "total")
    return found.select(F.col("a").alias(left_id), F.explode("bs.id").alias(right_id), "common", "total")


def same_record(hint: Column, authors: Column, title_a: Column, title_b: Column, least: float = 0.5) -> Column:
    """Whether a looked-up record can be the wanted one: a family name in common where there is a hint, else similar titles.

    ``hint`` is an author's name, ``authors`` the family names of the record; short or tokenless titles are accepted.
    """
    parts = lambda c: F.filter(F.split(F.lower(c), r"[\s\-']+"), lambda w: F.length(w) > 1)
    named = F.coalesce(F.length(hint) > 0, F.lit(False)) & F.coalesce(F.size(authors) > 0, F.lit(False))
    family = F.arrays_overlap(parts(hint), F.flatten(F.transform(F.coalesce(authors, F.array().cast("array<string>")), lambda a: parts(a))))
    short = (F.length(F.coalesce(title_a, F.lit(""))) < 10) | (F.length(F.coalesce(title_b, F.lit(""))) < 10) | (F.size(X.tokens(title_a)) == 0) | (F.size(X.tokens(title_b)) == 0)
    return F.when(named, F.coalesce(family, F.lit(False))).otherwise(short | (X.jaccard(X.tokens(title_a), X.tokens(title_b)) >= least))


def patch(base: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``base`` with the columns of the update of the same key where that has a value. Keys of ``updates`` are unique."""
    new = updates.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    return base.join(new, keys, "left").select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in base.columns])


def trees(nodes: DataFrame, key: str, parent: str, group: str | None = None) -> DataFrame:
    """(group, key, root, depth) of every node that leads to a root; orphans and cycles are left out.

    Pointer jumping: each round doubles the distance that a node looks ahead, so a tree of depth d takes log2(d) joins
    and no recursion limit holds. The rounds are checked only by whether any node still moves.
    """
    from leafmill.session import materialize

    keys = [group] if group else []
    at = nodes.select(*keys, key, F.coalesce(F.col(parent), F.col(key)).alias("up"), F.when(F.col(parent).isNull(), 0).otherwise(1).alias("depth"))
    at, rounds = materialize(at, "tree"), 0
    while rounds < 40:
        ahead = at.select(*keys, F.col(key).alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = materialize(at.join(ahead, [*keys, "up"], "inner").select(*keys, key, F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth")), "tree")
        rounds += 1
        changed = moved.join(at.select(*keys, key, F.col("up").alias("was")), [*keys, key]).filter("up <> was").isEmpty()
        at = moved
        if changed or rounds > 32:
            break
    roots = nodes.filter(F.col(parent).isNull()).select(*keys, F.col(key).alias("up"))
    return at.join(roots, [*keys, "up"], "left_semi").select(*keys, key, F.col("up").alias("root"), "depth")


def within_band(points: DataFrame, bands: DataFrame, keys: list[str], at: str, low: str, high: str, width: int) -> DataFrame:
    """Join of points with the bands that hold them, on the keys and a bucket of ``width``: a band is filed under every
    bucket it meets."""
    p = points.withColumn("__b", F.floor(F.col(at) / width))
    b = bands.withColumn("__b", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(b, [*keys, "__b"]).filter((F.col(at) >= F.col(low)) & (F.col(at) <= F.col(high))).drop("__b")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """``left`` with the latest value of ``right`` at or before its time, by one sort of both sides together.

    At equal times the value of ``right`` is seen; of several at one time the greatest. Rows before the first are null.
    """
    both = left.withColumn("__v", F.lit(None).cast(right.schema[value].dataType)).withColumn("__s", F.lit(1))
    other = right.groupBy(*keys, at).agg(F.max(value).alias("__v")).withColumn("__s", F.lit(0))
    for c in left.columns:
        if c not in (*keys, at):
            other = other.withColumn(c, F.lit(None).cast(left.schema[c].dataType))
    order = Window.partitionBy(*keys).orderBy(at, "__s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.unionByName(other).withColumn(value, F.last("__v", ignorenulls=True).over(order)).filter("__s = 1").drop("__v", "__s")
