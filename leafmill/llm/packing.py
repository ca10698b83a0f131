"""Filling containers of fixed capacity by hierarchical residual packing.

Items are packed best-fit inside bounded groups. Best fit leaves one bin per group at most that is no more than half full;
two fuller ones can't be joined, so only those bins can still be saved. They go up as items of their own into fewer groups,
with as many of the emptiest other bins to be joined with (no others could take more of them), and are packed again,
until one group is left. Nearly full bins and all others are done.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialize

#: Items of a group, the most that one task packs at once.
GROUP = 20_000
#: Share of the capacity at which a bin is done.
FULL = 0.995


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Places in ``sizes`` by bin: largest first, each into the fullest bin that still takes it."""
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    bins: list[list[int]] = []
    for place in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[place]
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room, number = capacity, len(bins)
            bins.append([])
        bins[number].append(place)
        if room > size or size == 0:
            insort(rooms, (room - size, number))
    return bins


def cut_items(sized: DataFrame, key: str, specs: list[tuple[str, int, int]]) -> DataFrame:
    """(spec_name, capacity, item, piece_no, start_at, size): every item under every spec; one that is longer than the
    capacity is cut into pieces of the capacity that overlap as the spec says."""
    rows = [F.struct(F.lit(n).alias("spec_name"), F.lit(c).alias("capacity"), F.lit(c - o).alias("step"), F.lit(o).alias("overlap")) for n, c, o in specs]
    each = sized.select(F.col(key).alias("item"), F.col("tokens"), F.explode(F.array(*rows)).alias("s")).select("item", "tokens", "s.*")
    pieces = F.greatest(F.lit(1), F.ceil((F.col("tokens") - F.col("overlap")) / F.col("step"))).cast("int")
    whole = F.col("tokens") <= F.col("capacity")
    cut = each.withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.when(whole, F.lit(0)).otherwise(pieces - 1))))
    start = F.col("piece_no") * F.col("step")
    return cut.select("spec_name", "capacity", "item", "piece_no", start.alias("start_at"), F.least("capacity", F.col("tokens") - start).alias("size"))


def pack(items: DataFrame, group: int = GROUP) -> DataFrame:
    """(spec_name, capacity, container_id, item, piece_no, start_at, size): each piece in one container.

    ``items`` is the result of cut_items. Items of size 0 take no room and share bins, one per group. Repeated items are packed as often as they
    occur; no items give no containers. A container's id is that of its first member within the spec.
    """
    kind = items.schema["item"].dataType.simpleString()
    member = f"struct<item: {kind}, piece_no: int, start_at: int, size: int>"
    bins_schema = f"spec_name string, capacity int, size int, members array<{member}>"
    bins = materialize(items.select("spec_name", "capacity", "size", F.array(F.struct("item", "piece_no", "start_at", "size")).alias("members")), "bins")
    def local(rows: pd.DataFrame) -> pd.DataFrame:
        capacity = int(rows["capacity"].iloc[0])
        sizes, members = rows["size"].tolist(), rows["members"].tolist()
        out = [(rows["spec_name"].iloc[0], capacity, sum(sizes[i] for i in b), [m for i in b for m in members[i]]) for b in best_fit(sizes, capacity)]
        return pd.DataFrame(out, columns=["spec_name", "capacity", "size", "members"])

    finished: list[DataFrame] = []
    open_bins, salt = bins, 0
    half = F.col("size") * 2 <= F.col("capacity")
    while True:
        counts = {r.spec_name: r["count"] for r in open_bins.groupBy("spec_name").count().collect()}
        if not counts:
            break
        groups = {n: -(-c // group) for n, c in counts.items()}
        parts = F.coalesce(*[F.when(F.col("spec_name") == n, F.lit(g)) for n, g in groups.items()])
        placed = open_bins.withColumn("part", F.pmod(F.xxhash64(F.get("members", F.lit(0))["item"], F.get("members", F.lit(0))["piece_no"], F.lit(salt)), parts))
        packed = materialize(placed.groupBy("spec_name", "part").applyInPandas(local, bins_schema), "packed")
        # Bins of size 0 stay apart: their members would have no bound. A spec that was one group is done.
        over = [n for n, g in groups.items() if g == 1]
        done = (F.col("size") >= FULL * F.col("capacity")) | (F.col("size") == 0) | F.col("spec_name").isin(over)
        loose = {r.spec_name: r["count"] for r in packed.filter(~done & half).groupBy("spec_name").count().collect()}
        finished.append(packed.filter(done | ~F.col("spec_name").isin(list(loose))))
        if not loose:
            break
        up = packed.filter(~done & half)
        for n, c in sorted(loose.items()):
            hosts = packed.filter((F.col("spec_name") == n) & ~done & ~half).withColumn("id", F.xxhash64("members"))
            last = hosts.orderBy("size", "id").select("size", "id").limit(c).agg(F.max(F.struct("size", "id")).alias("m")).first().m
            if last is not None:
                chosen = (F.col("size") < last["size"]) | (F.col("size") == last["size"]) & (F.col("id") <= last["id"])
                up = up.unionByName(hosts.filter(chosen).drop("id"))
                finished.append(hosts.filter(~chosen).drop("id"))
        open_bins, salt = materialize(up, "up"), salt + 1
    result = bins.limit(0)
    for part in finished:
        result = result.unionByName(part)
    first = F.array_min(F.transform("members", lambda m: F.struct(m["item"].alias("item"), m["piece_no"].alias("piece_no"))))
    named = result.withColumn("container_id", F.concat_ws("/", "spec_name", first["item"].cast("string"), first["piece_no"].cast("string")))
    return named.select("spec_name", "capacity", "container_id", F.explode("members").alias("m")).select("spec_name", "capacity", "container_id", "m.item", "m.piece_no", "m.start_at", "m.size")


def fill(packed: DataFrame) -> DataFrame:
    """(spec_name, containers, fewest, tokens, fill): the containers used, the fewest that could do, and the share used."""
    return packed.groupBy("spec_name").agg(F.count_distinct("container_id").alias("containers"), F.ceil(F.sum("size") / F.max("capacity")).alias("fewest"), F.sum("size").alias("tokens"), F.max("capacity").alias("capacity")).select("spec_name", "containers", "fewest", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 4).alias("fill"))
