"""One surviving record per duplicate group by Bayesian fusion with copy detection.

Every run of a file votes for its values. A source is an extraction method with its verification state and a band of
the quality that it reports. In rounds over all files the accuracy of each source is estimated, and for each pair of
sources the probability that one copies the other, from the false values they share, the true ones they share, and
where they differ. A voter that follows others it may depend on counts by the chance that it doesn't copy them. The value of the
largest posterior survives: votes, form of the value, and how late it was still seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialize

FIELDS = ("title", "authors", "journal", "doi", "year", "volume", "pages")
# Strings that extractors leave in place of a value.
PLACEHOLDERS = ("unknown", "n/a", "na", "none", "null", "nil", "untitled", "anonymous", "-", "--", "?", "tbd", "title", "0", "0000", "not available", "no title", "et al.", "author", "authors", "various", "placeholder", "xxx")
_JUNK_TITLE = r"(?i)^(microsoft (word|powerpoint|excel)\b.*|untitled.*|document ?\d*|slide ?\d*|.*\.(docx?|pdf|pptx?|tex|indd|qxd|dvi)|scan[ _-]?\d*)$"
ROUNDS = 3
#: Number of false values taken to be possible for a field.
FALSE_VALUES = 10.0
#: Prior probability that two sources depend on each other, and the share of its values that a copier copies.
DEPENDENT, COPIED = 0.1, 0.8
#: Log odds by which each step of a value's form below sound is less likely to be true: forms outweigh votes, as the
#: problem asks, since an unsound value isn't true however many runs repeat it.
FORM = 60.0
#: Log odds of the newest value of a file against one as old as its oldest run.
FRESH = 4.0


def _flat(name: str) -> Column:
    c = F.col(f"metadata.{name}")
    return F.to_json(c) if name == "authors" else c


def _shape(field: Column, v: Column) -> Column:
    """3 sound, 2 cut or abbreviated, 1 unreadable or malformed, 0 placeholder, -1 absent; by the value alone."""
    bare = F.lower(F.trim(v))
    absent = v.isNull() | (F.trim(v) == "") | (v == "[]")
    plain = F.regexp_replace(F.regexp_replace(bare, r'^\["|"\]$', ""), r'","', " ")
    placeholder = plain.isin(*PLACEHOLDERS) | plain.rlike(r"^[\s\-–—?.,;:_*#/0]*$") | ((field == "title") & v.rlike(_JUNK_TITLE))
    unreadable = v.rlike("[�□\x00-\x08]") | v.contains("\\ufffd") | v.contains("???")
    ellipsis = v.rlike(r"(\.\.\.|…)\s*(\"\])?$") & ~((field == "journal") & v.rlike(r"\b\w+\. \w+\.$"))
    malformed = (
        F.when(field == "doi", ~v.rlike(r"^10\.\d{4,}/\S+$"))
        .when(field == "year", ~v.rlike(r"^(1[89]|20)\d\d$"))
        .when(field == "volume", ~v.rlike(r"\d"))
        .when(field == "pages", ~v.rlike(r"^[A-Za-z]?\d+(\s?[-–]\s?[A-Za-z]?\d+)?$"))
        .otherwise(F.lit(False))
    )
    short = (
        F.when(field == "journal", v.rlike(r"^(\S{1,6}\.\s)+\S+\.?$") | v.rlike(r"(?i)\s(of|in|and|on|the|for|&)$"))
        .when(field == "title", v.rlike(r"(?i)\s(of|in|and|on|the|for|with|by|a|an|to|from|as|:)$"))
        .when(field == "authors", v.rlike(r"et al"))
        .when(field == "doi", v.rlike(r"[./\-]$"))
        .otherwise(F.lit(False))
    )
    return F.when(absent, -1).when(placeholder, 0).when(unreadable | malformed, 1).when(ellipsis | short, 2).otherwise(3)


def claims(runs: DataFrame) -> DataFrame:
    """(file_id, field, value, shape, source, result_id, seen_at): a row per run and field, absent values too."""
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), _flat(f).alias("value")) for f in FIELDS])).alias("c")
    rows = runs.select(
        "file_id",
        "result_id",
        F.concat_ws("/", F.coalesce("extraction_method", F.lit("?")), F.coalesce(F.col("metadata.crossref_verified").cast("string"), F.lit("?")), F.coalesce(F.floor("quality_score.overall").cast("string"), F.lit("?"))).alias("source"),
        F.coalesce(F.unix_timestamp("processed_at"), F.lit(0)).alias("seen_at"),
        values,
    )
    return rows.select("file_id", "result_id", "source", "seen_at", F.col("c.field").alias("field"), F.col("c.value").alias("value")).withColumn("shape", _shape(F.col("field"), F.col("value")))


def _cut(votes: DataFrame) -> DataFrame:
    """Lowers the shape of values that are the beginning or a part of a fuller value of the same file.

    Sorted, a string comes directly before those that it begins, so one look at the next distinct value decides.
    """
    from pyspark.sql import Window

    stem = F.rtrim(F.regexp_replace("value", r"(\.\.\.|…|\])\s*$", ""))
    texts = votes.filter((F.col("shape") >= 2) & F.col("field").isin("title", "journal", "doi", "pages")).select("file_id", "field", "vh", stem.alias("stem")).distinct()
    # Equal stems (of several sources, with and without an ellipsis) must not stand between a beginning and its whole.
    order = Window.partitionBy("file_id", "field").orderBy("stem")
    stems = texts.select("file_id", "field", "stem").distinct().withColumn("next", F.lead("stem").over(order))
    beginnings = stems.filter(F.col("next").startswith(F.col("stem"))).select("file_id", "field", "stem")
    begun = texts.join(beginnings, ["file_id", "field", "stem"]).select("file_id", "field", "vh")
    lists = votes.filter((F.col("field") == "authors") & (F.col("shape") >= 2)).select("file_id", "field", "vh", F.from_json("value", "array<string>").alias("people"))
    fullest = lists.groupBy("file_id").agg(F.max_by("people", F.struct(F.size("people"), F.hash("people"))).alias("full"))
    part = lists.join(fullest, "file_id").filter((F.size("people") < F.size("full")) & (F.size(F.array_except("people", "full")) == 0)).select("file_id", "field", "vh")
    cut = begun.unionByName(part).withColumn("is_cut", F.lit(True))
    return votes.join(cut.distinct(), ["file_id", "field", "vh"], "left").withColumn("shape", F.when(F.col("is_cut"), F.least("shape", F.lit(2))).otherwise(F.col("shape"))).drop("is_cut")


def _votes(patterns: DataFrame, accuracy: DataFrame, copying: DataFrame) -> DataFrame:
    """(voters, votes): summed log odds of a set of voters. The voters are taken from the most accurate on; each counts by
    the chance that it copies none before it. Values with the same voters share a pattern, so pairs of voters are only
    made once per pattern."""
    one = patterns.select("voters", F.explode("voters").alias("s")).join(F.broadcast(accuracy), "s")
    pairs = one.select("voters", "s", "a").join(one.select("voters", F.col("s").alias("t"), F.col("a").alias("b")), "voters")
    before = pairs.filter((F.col("b") > F.col("a")) | (F.col("b") == F.col("a")) & (F.col("t") < F.col("s")))
    known = before.withColumn("lo", F.least("s", "t")).withColumn("hi", F.greatest("s", "t")).join(F.broadcast(copying), ["lo", "hi"], "left")
    free = known.groupBy("voters", "s").agg(F.exp(F.sum(F.log(1 - COPIED * F.coalesce("copies", F.lit(DEPENDENT))))).alias("free"))
    odds = F.log(FALSE_VALUES * F.col("a") / (1 - F.col("a")))
    return one.join(free, ["voters", "s"], "left").groupBy("voters").agg(F.sum(odds * F.coalesce("free", F.lit(1.0))).alias("votes"))


def _pairs(sets: DataFrame, name: str) -> DataFrame:
    """(lo, hi, name): how often two sources stand in one set of ``sets`` (voters); equal sets are counted first."""
    counted = sets.groupBy("voters").agg(F.count("*").alias("n"))
    two = counted.select("n", "voters", F.explode("voters").alias("lo")).select("n", "lo", F.explode("voters").alias("hi")).filter("lo < hi")
    return two.groupBy("lo", "hi").agg(F.sum("n").cast("double").alias(name))


def copying(judged: DataFrame, accuracy: DataFrame) -> DataFrame:
    """(lo, hi, copies): the probability that one of two sources copies the other.

    ``judged`` has a row per file, field and value with its ``voters`` and whether it is ``right``. Shared false values
    speak for copying most: two independent sources hardly ever make the same mistake.
    """
    together = judged.groupBy("file_id", "field").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("voters")))).alias("voters"))
    counts = _pairs(together, "both").join(_pairs(judged.filter("right"), "true"), ["lo", "hi"], "left").join(_pairs(judged.filter("not right"), "false"), ["lo", "hi"], "left").fillna(0.0)
    counts = counts.join(accuracy.select(F.col("s").alias("lo"), F.col("a").alias("a")), "lo").join(accuracy.select(F.col("s").alias("hi"), F.col("a").alias("b")), "hi")
    a, b, c = F.col("a"), F.col("b"), F.lit(COPIED)
    mean = (a + b) / 2
    true, false = a * b, (1 - a) * (1 - b) / FALSE_VALUES
    differ = 1 - true - false
    other = F.greatest(F.lit(0.0), F.col("both") - F.col("true") - F.col("false"))
    evidence = F.col("true") * F.log((mean * c + true * (1 - c)) / true) + F.col("false") * F.log(((1 - mean) * c + false * (1 - c)) / false) + other * F.log(1 - c)
    return counts.select("lo", "hi", (1 / (1 + (1 - DEPENDENT) / DEPENDENT * F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), evidence))))).alias("copies"))


def fuse(runs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(file_id, field, result_id, vh, value, confidence): the surviving value of each field of each file.

    Files with one run are kept. A field with no sound value gets the least bad one (cut, then unreadable, then
    placeholder, then absent). Ties go to the newer run, then to the lower ``result_id``. Null ``file_id`` rows form no
    group and are left out; repeated rows count once; an empty table gives no rows. What is shared with all tasks is a
    row per source and per pair of sources: methods by states by quality bands, however many the runs.
    """
    base = claims(runs.filter(F.col("file_id").isNotNull())).withColumn("vh", F.coalesce(F.xxhash64("value"), F.lit(0)))
    votes = base.groupBy("file_id", "field", "vh").agg(F.array_sort(F.collect_set(F.xxhash64("source"))).alias("voters"), F.max("seen_at").alias("seen_at"), F.min("result_id").alias("result_id"), F.any_value("value").alias("value"), F.max("shape").alias("shape"))
    votes = materialize(_cut(votes), "claims")
    times = votes.groupBy("file_id").agg(F.min("seen_at").alias("oldest"), F.max("seen_at").alias("newest"))
    slim = materialize(votes.drop("value").join(times, "file_id").withColumn("prior", FRESH * (F.col("seen_at") - F.col("oldest")) / F.greatest(F.col("newest") - F.col("oldest"), F.lit(1)) - FORM * (3 - F.col("shape"))).drop("oldest", "newest"), "slim")
    patterns = materialize(slim.select("voters").distinct(), "patterns")
    held = slim.select("shape", F.explode("voters").alias("s"))
    # Before any value is judged, a source is as accurate as its values are sound.
    accuracy = held.groupBy("s").agg(((F.sum((F.col("shape") == 3).cast("double")) + 1) / (F.count("*") + 2)).alias("a"))
    pairs = patterns.select(F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"), F.lit(0.0).alias("copies")).limit(0)
    for step in range(rounds + 1):
        accuracy, pairs = materialize(accuracy, "accuracy"), materialize(pairs, "copying")
        scored = slim.join(_votes(patterns, accuracy, pairs), "voters").withColumn("score", F.col("votes") + F.col("prior"))
        rank = F.struct("score", "seen_at", (-F.col("result_id")).alias("neg"))
        best = scored.groupBy("file_id", "field").agg(F.max_by(F.struct("vh", "result_id", "score"), rank).alias("b"), F.sum(F.exp(F.least(F.col("score"), F.lit(600.0)))).alias("mass"))
        if step == rounds:
            break
        judged = materialize(slim.filter("shape >= 2").select("file_id", "field", "vh", "voters").join(best.select("file_id", "field", F.col("b.vh").alias("truth")), ["file_id", "field"]).select("file_id", "field", "voters", (F.col("vh") == F.col("truth")).alias("right")), "judged")
        accuracy = judged.select("right", F.explode("voters").alias("s")).groupBy("s").agg(F.least(F.lit(0.99), F.greatest(F.lit(0.05), (F.sum(F.col("right").cast("double")) + 1) / (F.count("*") + 2))).alias("a"))
        # A source without a readable value has no say; it keeps a row, so that its values keep theirs.
        accuracy = materialize(held.select("s").distinct().join(accuracy, "s", "left").select("s", F.coalesce("a", F.lit(0.05)).alias("a")), "accuracy")
        pairs = copying(judged, accuracy)
    picked = best.select("file_id", "field", F.col("b.vh").alias("vh"), F.col("b.result_id").alias("result_id"), (F.exp(F.least(F.col("b.score"), F.lit(600.0))) / F.col("mass")).alias("confidence"))
    return picked.join(votes.select("file_id", "field", "vh", "value"), ["file_id", "field", "vh"])
