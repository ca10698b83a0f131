"""Incremental runs: seen keys, groups to make again, histories that late rows may change, windows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def unseen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(seen.select(*keys).distinct(), keys, "left_anti")


def changed_groups(df: DataFrame, seen: DataFrame, key: str, group: str) -> DataFrame:
    """All rows of the groups that hold a row not seen yet."""
    return df.join(unseen(df, seen, [key]).select(group).distinct(), group, "left_semi")


def once_per_key(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """Rows of a stream whose key wasn't there within the watermark."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def regroup(stream: DataFrame, all_rows: Callable[[], DataFrame], group: str, write: Callable[[DataFrame, int], None]):
    """A writer that makes every group again that a batch touches; ``write`` replaces whole groups, so a retry does no harm."""

    def batch(rows: DataFrame, number: int) -> None:
        touched = rows.select(group).distinct()
        write(all_rows().join(touched, group, "left_semi"), number)

    return stream.writeStream.foreachBatch(batch)


def tumbling(df: DataFrame, at: str, width: str, *keys: str, delay: str | None = None) -> DataFrame:
    """(window_start, keys, n) of rows by time window; in a stream with a watermark of ``delay``."""
    rows = df.withWatermark(at, delay) if delay else df
    return rows.groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


def history(stream: DataFrame, key: str, field: str, at: str, value: str, delay: str = "365 days") -> DataFrame:
    """(key, field, at, old, new) change rows of a stream, with state per key and field.

    A late row is put in its place among the observations that are kept, so the log it gives is that of the rows in order
    of time; a change that it undoes is not taken back, since a stream only appends. Kept are the observations within
    ``delay`` of the latest time and the last one before them, so the state of a key stays as large as its recent past; a
    row that is later than all that is kept of its past gives no change.
    """
    schema = f"{key} string, {field} string, {at} timestamp, old string, new string"

    def run(k: tuple, batches, state: GroupState):
        seen = list(zip(*state.get)) if state.exists else []
        out = []
        for b in batches:
            for t, v in sorted(zip(b[at], b[value])):
                if v is None or v == "":
                    continue
                stamp = pd.Timestamp(t).value
                before = [x for x in seen if x[0] <= stamp]
                if before and before[-1][1] != v:
                    out.append((k[0], k[1], t, before[-1][1], v))
                seen = sorted({*seen, (stamp, v)})
        mark = state.getCurrentWatermarkMs() * 1_000_000
        old = [x for x in seen if x[0] < mark]
        seen = old[-1:] + seen[len(old) :]
        state.update(([s for s, _ in seen], [v for _, v in seen]))
        yield pd.DataFrame(out, columns=[key, field, at, "old", "new"])

    return stream.withWatermark(at, delay).groupBy(key, field).applyInPandasWithState(run, schema, "stamps array<long>, vals array<string>", "append", GroupStateTimeout.NoTimeout)
