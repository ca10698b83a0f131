"""Mixing sources to target shares by pivotal dependent rounding.

Every document of a source gets the same fractional number of copies, the one that gives the source its share. Its
whole part is taken; the fractions are rounded in pairs: mass (in tokens) moves at random from one document of a pair
to the other until one of them is a whole number, so every document keeps its expected copies and a source keeps its
total. Each bounded group leaves at most one fraction, and those are rounded against each other group of groups by
group of groups, until a source has one left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.session import materialize

#: Documents that one task rounds at once.
GROUP = 50_000
_EPS = 1e-9


def pivotal(p: list[float], w: list[float], rng: np.random.Generator) -> list[float]:
    """Rounds the fractions ``p`` of items of weight ``w`` to 0 or 1, all but at most one, keeping sum(p * w)."""
    out = list(p)
    held = -1
    for i in range(len(out)):
        if not _EPS < out[i] < 1 - _EPS:
            out[i] = float(round(out[i]))
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min(w[a] * (1 - out[a]), w[b] * out[b])
        down = min(w[a] * out[a], w[b] * (1 - out[b]))
        move = up if rng.random() * (up + down) < down else -down
        out[a] += move / w[a]
        out[b] -= move / w[b]
        whole = [not _EPS < out[x] < 1 - _EPS for x in (a, b)]
        for x, done in zip((a, b), whole):
            if done:
                out[x] = float(round(out[x]))
        held = -1 if all(whole) else a if whole[1] else b
    return out


def plan(totals: dict[str, int], targets: dict[str, tuple[float, int]], size: float | None = None) -> dict[str, float]:
    """Copies of each document of each source, a fraction.

    Sources without a target or without tokens take no part, and the shares of the others are scaled to sum to 1. The
    mix is as large as the scarcest source allows at its cap, so that all shares can be met; a given ``size`` (tokens)
    is kept instead, and sources then stop at their cap.
    """
    present = {s: t for s, t in targets.items() if totals.get(s, 0) > 0 and t[0] > 0 and t[1] > 0}
    whole = sum(share for share, _ in present.values())
    if not present:
        return {}
    most = min(cap * totals[s] * whole / share for s, (share, cap) in present.items())
    size = most if size is None else size
    return {s: min(float(cap), size * share / whole / totals[s]) for s, (share, cap) in present.items()}


def mix(sized: DataFrame, targets: DataFrame, key: str, seed: int = 7, size: float | None = None, group: int = GROUP) -> DataFrame:
    """(source, key, tokens, copies) of the documents that are used, ``copies`` of at least 1 and at most the cap.

    ``sized`` has key, source and tokens; ``targets`` has source, target_share and max_repeats, a row per source (a
    table of the size of the sources, not of the documents; of repeated rows the first by share counts). Documents with a
    null source or without tokens are not used. Repeated keys are rounded row by row.
    """
    wanted = {r.source: (r.target_share, r.max_repeats) for r in targets.filter("source is not null and target_share is not null and max_repeats is not null").orderBy(F.desc("source"), F.desc("target_share")).collect()}
    used = sized.filter(F.col("source").isin(list(wanted)) & (F.col("tokens") > 0))
    sums = {r.source: (r.tokens, r.n) for r in used.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")).collect()}
    copies = plan({s: t for s, (t, _) in sums.items()}, wanted, size)
    kind = sized.schema[key].dataType.simpleString()
    schema = f"source string, k {kind}, tokens int, base int, part long, fraction double"
    if not copies:
        return sized.select("source", F.col(key), "tokens", F.lit(1).alias("copies")).limit(0)
    share = F.coalesce(*[F.when(F.col("source") == s, F.lit(x)) for s, x in copies.items()])
    parts = F.coalesce(*[F.when(F.col("source") == s, F.lit(-(-n // group))) for s, (_, n) in sums.items()])
    rows = used.filter(F.col("source").isin(list(copies))).withColumn("x", share)
    rows = rows.select("source", F.col(key).alias("k"), "tokens", F.floor(F.col("x") + _EPS).cast("int").alias("base"), F.pmod(F.xxhash64(F.col(key), F.lit(seed)), parts).cast("long").alias("part"), F.greatest(F.lit(0.0), F.col("x") - F.floor(F.col("x") + _EPS)).alias("fraction"))

    def rounded(level: int):
        def run(b: pd.DataFrame) -> pd.DataFrame:
            b = b.sort_values(["k", "tokens"], kind="stable")
            rng = np.random.default_rng([seed, level, int(b["part"].iloc[0]), *b["source"].iloc[0].encode()])
            b = b.sample(frac=1.0, random_state=rng)
            b["fraction"] = pivotal(b["fraction"].tolist(), b["tokens"].tolist(), rng)
            return b

        return run

    whole = F.col("fraction").isin(0.0, 1.0)
    settled, level, most = [], 0, max(-(-n // group) for _, n in sums.values())
    while True:
        rows = materialize(rows.groupBy("source", "part").applyInPandas(rounded(level), schema), "rounded")
        settled.append(rows.filter(whole))
        if most == 1:
            # What is left of a source is less than one document; the nearer whole number leaves its total nearest.
            settled.append(rows.filter(~whole).withColumn("fraction", F.round("fraction")))
            break
        rows = rows.filter(~whole).withColumn("part", F.floor(F.col("part") / 1000))
        most, level = -(-most // 1000), level + 1
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out.select("source", F.col("k").alias(key), "tokens", (F.col("base") + F.col("fraction")).cast("int").alias("copies")).filter("copies > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, documents, most_copies): a row per target, reached or not."""
    by = mixed.groupBy("source").agg(F.sum(F.col("tokens").cast("long") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    # One row per target is left here, so a window over all of them is small.
    rows = targets.select("source", "target_share").join(by, "source", "left").withColumn("total", F.sum("tokens").over(Window.partitionBy(F.lit(0))))
    return rows.select("source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)), 6).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
