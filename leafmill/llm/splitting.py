"""Splitting oversized texts at natural boundaries by agglomerative merging.

Atomic segments (sentences, lines, words of overlong sentences) are joined bottom-up: the adjacent pair with the
weakest boundary between them is merged first, while the merged core plus the overlap still fits the capacity.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strength of a boundary, by what ends there.
HARD, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH, SECTION = range(7)
_ENDS = re.compile(r"\n[ \t\r]*\n\s*|\n|[.!?。！？…]+[\"'”’»)\]]*(?:[ \t]+|(?<=[。！？]))|[;:,][ \t]+")
_HEADING = re.compile(r"(?:#{1,6} |\d+(?:\.\d+)*\.? +[A-Z]|[A-Z][A-Z \-]{3,60}$)")


def _strength(text: str, match: re.Match) -> int:
    found = match.group()
    if found.count("\n") > 1:
        line = text[match.end() : match.end() + 80].split("\n", 1)[0]
        return SECTION if _HEADING.match(line) else PARAGRAPH
    if "\n" in found:
        return LINE
    return CLAUSE if found[0] in ";:," else SENTENCE


def _fine(text: str, start: int, end: int, limit: int) -> Iterator[tuple[int, int]]:
    """Ends of atoms within an overlong stretch: at white space, else by force, never before a combining mark."""
    while end - start > limit:
        cut = text.rfind(" ", start + limit // 2, start + limit)
        if cut >= 0:
            cut, kind = cut + 1, WORD
        else:
            cut, kind = start + limit, HARD
            while cut > start + 1 and (unicodedata.combining(text[cut]) or text[cut] in "‍️"):
                cut -= 1
        yield cut, kind
        start = cut


def atoms(text: str, limit: int) -> tuple[list[int], list[int]]:
    """Ends of the atomic segments and the strength of the boundary at each end."""
    ends: list[int] = []
    kinds: list[int] = []
    start = 0
    for at, kind in [(m.end(), _strength(text, m)) for m in _ENDS.finditer(text)] + [(len(text), SECTION)]:
        if at <= start:
            continue
        for cut, fine in _fine(text, start, at, limit):
            ends.append(cut)
            kinds.append(fine)
        ends.append(at)
        kinds.append(kind)
        start = at
    return ends, kinds


def pieces(text: str, capacity: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of each piece in code points.

    Cores follow one another without a gap; every piece but the first is preceded by exactly ``overlap`` characters of
    the text before its core (fewer only where the text has fewer). A text within the capacity is one piece.
    """
    n = len(text)
    if n <= capacity:
        return [(0, n)]
    room = capacity - overlap
    if room < 1:
        raise ValueError("the overlap must be smaller than the capacity")
    ends, kinds = atoms(text, room)
    count = len(ends)
    begin = [0, *ends[:-1]]
    end = list(ends)
    after = list(range(1, count + 1))  # the next live segment
    before = list(range(-1, count - 1))
    live = [True] * count
    heap = [(kinds[i], end[i + 1] - begin[i], i, end[i], end[i + 1]) for i in range(count - 1)]
    heapq.heapify(heap)
    while heap:
        kind, size, i, cut, stop = heapq.heappop(heap)
        j = after[i] if live[i] else count
        if j >= count or end[i] != cut or end[j] != stop or stop - begin[i] != size:
            continue  # superseded by a later merge
        if size > (capacity if begin[i] == 0 else room):
            continue
        live[j] = False
        end[i], kinds[i] = stop, kinds[j]
        after[i] = after[j]
        if after[i] < count:
            before[after[i]] = i
            heapq.heappush(heap, (kinds[i], end[after[i]] - begin[i], i, stop, end[after[i]]))
        if before[i] >= 0:
            h = before[i]
            heapq.heappush(heap, (kinds[h], stop - begin[h], h, end[h], stop))
    return [(max(0, begin[i] - (overlap if i else 0)), end[i]) for i in range(count) if live[i]]


def split_oversized(df: DataFrame, key: str, text: str, capacity: int, overlap: int) -> DataFrame:
    """(key, piece_no, n_pieces, start_at, end_at, piece) of each text over the capacity.

    Null and empty texts and texts within the capacity give no rows; repeated keys are split row by row. Only the two
    named columns are read, so further columns can't clash. The length test runs before any Python.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t in zip(batch["k"], batch["t"]):
                cut = pieces(t, capacity, overlap)
                rows += [(k, i, len(cut), a, b, t[a:b]) for i, (a, b) in enumerate(cut)]
            yield pd.DataFrame(rows, columns=[key, "piece_no", "n_pieces", "start_at", "end_at", "piece"])

    big = df.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.length("t") > capacity)
    return big.mapInPandas(run, f"`{key}` {kind}, piece_no int, n_pieces int, start_at int, end_at int, piece string")
