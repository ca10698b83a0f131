"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file; its place on the executors is a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: A run without white space that is longer than this is cut into parts of this length before it is tokenized, since merging
#: takes time that grows with its square; the text around it isn't cut.
LONG_RUN = 4096
_RUNS = re.compile(rf"\S{{{LONG_RUN + 1},}}")


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file) if a}
    return tiktoken.Encoding("leafmill", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str | None, path: str = VOCABULARY) -> int:
    """Tokens of a text; null and empty texts have none."""
    if not text:
        return 0
    encode = encoder(path).encode_ordinary
    total, done = 0, 0
    for run in _RUNS.finditer(text) if len(text) > LONG_RUN else ():
        # A blank before the run belongs to its first part.
        start = run.start() - 1 if text[run.start() - 1 : run.start()] == " " else run.start()
        total += len(encode(text[done:start])) + sum(len(encode(text[i : min(i + LONG_RUN, run.end())])) for i in range(start, run.end(), LONG_RUN))
        done = run.end()
    return total + len(encode(text[done:]))


def with_tokens(docs: DataFrame, text: str, keep: list[str], path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``tokens``. The text goes to Python and doesn't come back."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + ", tokens int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["tokens"] = [count(t, path) for t in b["__text"]]
            yield b[[*keep, "tokens"]]

    return docs.select(*keep, F.col(text).alias("__text")).mapInPandas(run, schema)
