"""Benchmark passages in documents, found by the q-gram lemma and verified by banded alignment.

Method. If a passage of a text is within ``k`` edits of an item of ``m`` characters, the two share
at least ``m + 1 - q * (k + 1)`` q-grams, and these lie on ``k + 1`` neighbouring diagonals (place in
the text less place in the item). Shared q-grams are counted per item in bands of diagonals that
overlap by half; bands that reach the bound are aligned with the item, with no cost for the text
around it, in a band of diagonals. Characters are compared in lower case, with every run of
anything but letters and digits as one blank.

The edit budget is ``floor(rate * m)``, lowered where the bound would fall under ``q``; items are
read in blocks of bounded size, each of which all documents pass.

Defined cases: null text counts as empty and holds no passage, and null or blank items are found
nowhere; rows without id are searched too; repeated rows each give their rows, repeated items as
well; empty tables give an empty table or leave all documents; further columns are ignored by the
search and kept by the filter. Texts are read whole, a block of bounded size at a time, with
overlaps that hold a whole item.
"""

from __future__ import annotations

import unicodedata
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_batches
from .common import Sink, give_back, per_process, rows_of, whole_text
from .wordhash import mix

RATE = 0.07
Q = 8
#: Pairs of a text's and an item's equal q-grams that are counted at once.
SHARED_GRAMS = 1 << 20
BLOCK_CHARS = 2_000_000
TEXT_BLOCK = 1 << 19
_FILTER_BITS = 22
_NOTHING = 0xFFFFFFFF


class Item(NamedTuple):
    key: int | None
    points: np.ndarray
    q: int
    edits: int

    @property
    def least(self) -> int:
        """The number of shared q-grams that a passage within the budget has."""
        return len(self.points) + 1 - self.q * (self.edits + 1)


class Folded:
    """Characters in lower case, with one blank for every run of others; and where they stood."""

    def __init__(self):
        table = np.full(0x110000, 0x20, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if unicodedata.category(char)[0] in "LNM":
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
        self.table = table

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        points = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = points == 0x20
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        at = np.flatnonzero(keep)
        return points[at], at


def _folded() -> Folded:
    return per_process(("folded",), Folded)


def item_of(key: int | None, text: str | None, rate: float = RATE, q: int = Q) -> Item | None:
    points, _ = _folded().of(text or "")
    while len(points) and points[0] == 0x20:
        points = points[1:]
    while len(points) and points[-1] == 0x20:
        points = points[:-1]
    m = len(points)
    if not m:
        return None
    q = max(1, min(q, m // 8))
    return Item(key, points, q, max(0, min(int(rate * m), (m + 1) // q - 2)))


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    out = points[:len(points) - q + 1].astype(np.uint64)
    for k in range(1, q):
        out = out * np.uint64(0x100000001B3) ^ points[k:len(points) - q + 1 + k]
    return mix(out)


class Index:
    """Items of one q-gram length: from the hash of a q-gram to its items and places."""

    def __init__(self, items: list[Item], q: int):
        self.items, self.q = items, q
        grams = [_grams(x.points, q) for x in items]
        hashes = np.concatenate(grams)
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.known, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(hashes))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - _FILTER_BITS)] = True
        self.edits = np.array([x.edits for x in items])
        self.least = np.array([x.least for x in items])
        self.longest = max(len(x.points) + x.edits for x in items)

    def regions(self, points: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Item number and first and last diagonal of the bands that reach their item's bound."""
        if len(points) < self.q:
            return
        grams = _grams(points, self.q)
        at = np.flatnonzero(self.filter[grams >> np.uint64(64 - _FILTER_BITS)])
        found = np.searchsorted(self.known, grams[at])
        found[found == len(self.known)] = 0
        same = self.known[found] == grams[at]
        at, found = at[same], found[same]
        if not len(at):
            return
        counts = self.first[found + 1] - self.first[found]
        span = np.int64(len(points) + self.longest * 2 + 4)
        keys, hits = np.empty(0, np.int64), np.empty(0, np.int64)
        # bands are counted a chunk of shared grams at a time: a gram may stand at very many places of an item
        ends = np.cumsum(counts)
        start = 0
        while start < len(at):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SHARED_GRAMS, "right")))
            n = counts[start:stop]
            which = np.repeat(self.first[found[start:stop]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            owner = self.owner[which]
            band = (np.repeat(at[start:stop], n) - self.place[which]) // (self.edits[owner] + 1)
            mine, own = np.unique(np.concatenate((owner * span + band + self.longest + 1, owner * span + band + self.longest)),
                                  return_counts=True)
            both, back = np.unique(np.concatenate((keys, mine)), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, back, np.concatenate((hits, own)))
            keys, hits, start = both, total, stop
        item = keys // span
        enough = hits >= self.least[item]
        for number, key in zip(item[enough].tolist(), keys[enough].tolist()):
            low = (key - number * int(span) - self.longest - 1) * int(self.edits[number] + 1)
            yield number, low, low + 2 * int(self.edits[number]) + 1


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """Least edits between the item and a passage on diagonals ``low`` to ``high``, and where the
    passage begins and ends; None if it takes more than ``edits``."""
    low, high = low - edits, high + edits
    width = high - low + 1
    steps = np.arange(width)
    far = edits + 1
    # the text on all diagonals of all rows; beyond its ends stands what no item holds
    padded = np.full(len(item) + width, _NOTHING, np.uint32)
    first, last = max(low, 0), min(len(text), low + len(padded))
    if last > first:
        padded[first - low:last - low] = text[first:last]
    # cell d of row i: item[:i] against a passage that ends before text[i + low + d]
    cost = np.where((low + steps >= 0) & (low + steps <= len(text)), 0, far)
    begin = low + steps
    skip, source = np.full(width, far), begin.copy()
    for i, char in enumerate(item):
        row = padded[i:i + width]
        over = cost + (row != char)
        over[row == _NOTHING] = far
        # the item's character without one of the text: from the next diagonal
        skip[:-1] = cost[1:] + 1
        source[:-1] = begin[1:]
        take = skip < over
        new, origin = np.where(take, skip, over), np.where(take, source, begin)
        # characters of the text without one of the item: along the row
        best = new - steps
        run = np.minimum.accumulate(best)
        cost, begin = np.minimum(run + steps, far), origin[np.maximum.accumulate(np.where(best == run, steps, 0))]
        if i + low + 1 < 0 or i + low + width > len(text):
            ends = i + low + 1 + steps
            cost[(ends < 0) | (ends > len(text))] = far
        if cost.min() >= far:
            return None
    least = int(cost.min())
    d = int(np.argmin(cost))
    return (least, int(begin[d]), len(item) + low + d) if least <= edits else None


def _equal(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
    """The first passage on the diagonals that is the item itself."""
    for at in range(max(low, 0), min(high, len(text) - len(item)) + 1):
        if text[at] == item[0] and np.array_equal(text[at:at + len(item)], item):
            return 0, at, at + len(item)
    return None


class Search:
    """All items against texts."""

    def __init__(self, items: list[Item]):
        by_length: dict[int, list[Item]] = {}
        for item in items:
            by_length.setdefault(item.q, []).append(item)
        self.indexes = [Index(group, q) for q, group in sorted(by_length.items())]
        self.items = {(x.q, number): item for x in self.indexes for number, item in enumerate(x.items)}
        self.longest = max((x.longest for x in self.indexes), default=0)

    def text(self, text: str) -> list[tuple[int | None, tuple[int, int, int]]]:
        """For each item found (a row of the benchmark, whatever its id) its least edits and where that
        passage begins and ends."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        points, at = _folded().of(text)
        overlap = 2 * self.longest + 2
        for start in range(0, max(len(points), 1), TEXT_BLOCK):
            part = points[max(0, start - overlap):start + TEXT_BLOCK]
            shift = max(0, start - overlap)
            for index in self.indexes:
                for number, low, high in index.regions(part):
                    item, place = index.items[number], (index.q, number)
                    if place in best and not best[place][0]:
                        continue  # bands come in the order of the text
                    found = _equal(item.points, part, low, high) or align(item.points, part, low, high, item.edits)
                    if found is None:
                        continue
                    edits, begin, end = found[0], found[1] + shift, found[2] + shift
                    first = int(at[begin]) if begin < len(at) else len(text)
                    last = int(at[end - 1]) + 1 if end > begin else first
                    mine = (edits, first, last)
                    if place not in best or mine < best[place]:
                        best[place] = mine
        return [(self.items[place].key, hit) for place, hit in best.items()]


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, rate: float, q: int, block_chars: int):
    """Items of the benchmark in blocks of about ``block_chars`` characters, dealt by hash."""
    items = benchmark.select(F.col(id_column).cast("bigint").alias("item"), whole_text(text_column).alias("body"))
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    number = int(total // block_chars) + 1
    for block in range(number):
        rows = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(number)) == block).collect()
        found = [x for x in (item_of(key, body, rate, q) for key, body in rows) if x is not None]
        if found:
            yield found


_HIT = pa.schema([("row_key", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64()),
                  ("first_char", pa.int64()), ("last_char", pa.int64())])


def find(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         item_column: str = "item_id", item_text: str = "text", rate: float = RATE, q: int = Q,
         block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``<id>, item_id, edits, first_char, last_char``: for each text and item found in it the
    passage with the fewest edits, then the first; offsets are code points, the end exclusive."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
    out = None
    for items in _blocks(benchmark, item_column, item_text, rate, q, block_chars):
        def run(batches, items=items):
            search, sink = Search(items), Sink(_HIT)
            for key, body in rows_of(batches):
                for item, hit in search.text(body):
                    if sink.add((key, item, *hit)):
                        yield sink.flush()
            yield sink.flush()

        part = rows.mapInArrow(run, "row_key bigint, item_id bigint, edits bigint, first_char bigint, last_char bigint")
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = rows.where("false").selectExpr("row_key", *(f"CAST(NULL AS BIGINT) AS {c}" for c in _HIT.names[1:]))
    return out.withColumnRenamed("row_key", id_column)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
               item_text: str = "text", rate: float = RATE, q: int = Q, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns."""
    bounded_batches(docs.sparkSession)
    place = docs.columns.index(text_column)
    for items in _blocks(benchmark, item_column, item_text, rate, q, block_chars):
        def run(batches, items=items):
            search = Search(items)
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    clean = [not search.text(body or "") for body in part.column(place).to_pylist()]
                    yield part.filter(pa.array(clean, pa.bool_()))
            give_back("folded")

        docs = docs.mapInArrow(run, docs.schema)
    return docs
