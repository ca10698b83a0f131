"""Work that Spark can't do itself (reading pages from images, asking a model) behind one interface.

The offline provider answers nothing, and its rows carry the status 'unavailable', so a plan runs the same without it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Provider(Protocol):
    def call(self, kind: str, requests: list[str]) -> list[str | None]: ...


class OfflineProvider:
    def call(self, kind: str, requests: list[str]) -> list[str | None]:
        return [None] * len(requests)


class RetryingProvider:
    """Asks another provider again after errors, waiting twice as long each time; then gives up with null."""

    def __init__(self, inner: Provider, tries: int = 3, wait: float = 1.0) -> None:
        self.inner, self.tries, self.wait = inner, tries, wait

    def call(self, kind: str, requests: list[str]) -> list[str | None]:
        import time

        for i in range(self.tries):
            try:
                return self.inner.call(kind, requests)
            except (OSError, TimeoutError):
                time.sleep(self.wait * 2**i)
        return [None] * len(requests)


def ask(df: DataFrame, provider: Provider, kind: str, request: str, key: str, order: Column, budget: int, batch: int = 4) -> DataFrame:
    """``df`` with ``answer`` and ``status``: the first ``budget`` rows of each key are asked in batches.

    The budget is planned before any call, so it doesn't depend on how rows are spread over tasks.
    """
    planned = df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            answers: list[str | None] = []
            asked = b["__n"] <= budget
            todo = b.loc[asked, request].tolist()
            for i in range(0, len(todo), batch):
                answers += provider.call(kind, todo[i : i + batch])
            b = b.drop(columns="__n")
            b["answer"] = pd.Series([None] * len(b), index=b.index, dtype="object")
            b.loc[asked, "answer"] = answers
            b["status"] = ["over budget" if not a else "unavailable" if x is None else "ok" for a, x in zip(asked, b["answer"])]
            yield b

    return planned.mapInPandas(run, f"{fields}, answer string, status string")
