"""Spelling variants: words that differ by one letter, each pointed to its most frequent near word.

Method. A word's vector counts its letters by group (a letter's group is its code point modulo
``GROUPS``). One inserted letter adds one to one count, a deleted one takes one away, a replaced one
does both or neither. Vectors are arranged in a trie, a level for each group. A search goes down it
depth first and may once take an edge with one more (surplus) and once an edge with one less
(deficit); the words at the leaves that it reaches are verified letter by letter.

The trie is cut into subtrees of at most ``SUBTREE`` words: Spark goes down level by level with all
words at once, each carrying what is left of its surplus and deficit, and leaves a branch to one task
as soon as few enough words live in it. A word thus arrives at every subtree that can hold a near
word of it. The words that search a subtree are dealt out in blocks of about ``BLOCK``, each of which
meets the whole subtree, and words of one and the same vector beyond ``SUBTREE`` are dealt out in
parts, so that a task holds one subtree and streams one block whatever words are common. A pair is
met once from either side.

Defined cases: null words are ignored, and counts of a repeated word are added; a null count is 0; a
word of any length and any characters is compared by code points; an empty table gives an empty table;
further columns are ignored, whatever their names. Ties between near words of equal count go to the
smallest in code-point order.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage, task_slots
from .common import Sink, rows_of

GROUPS = 12
SUBTREE, BLOCK = 100_000, 100_000
#: Queries whose candidates are compared at once.
BATCH = 256
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- words ------------------------------------------------------------------------------

def runs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", points: int = 1) -> DataFrame:
    """``id, run`` for every maximal run of letters of at least ``points`` code points, A to Z lowered."""
    text = F.translate(F.col(text_column).cast("string"), CAPITALS, SMALL)
    found = F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{points},}}"), F.lit(0))
    return df.select(F.col(id_column).alias("id"), F.explode(found).alias("run"))


def without_letter(word: Column, at: Column) -> Column:
    """``word`` without the code point at place ``at``, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), at.cast("int")), F.substring(word, at.cast("int") + 2, F.length(word)))


def vocabulary(words: DataFrame, word: Column, points: int = 5, times: int = 3) -> DataFrame:
    """``word, n`` of the words of at least ``points`` code points that occur at least ``times`` times."""
    kept = words.select(word.alias("word")).where(F.length("word") >= points)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times)


# --- one subtree ------------------------------------------------------------------------

def vector(word: str) -> list[int]:
    counts = [0] * GROUPS
    for letter in word:
        counts[ord(letter) % GROUPS] += 1
    return counts


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    half = len(a) >> 1
    at = half if a[:half] == b[:half] else 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def _halves(words: list[str], less: int) -> np.ndarray:
    """16 bits each of hashes of the first and of the last letters, half as many as a word has; of a word
    that is the longer one of a pair (``less`` is 1), half as many as the other has."""
    keys = [(hash(w[:len(w) - less >> 1]) & 0xFFFF) << 16 | hash(w[len(w) - (len(w) - less >> 1):]) & 0xFFFF if w else 0 for w in words]
    return np.array(keys, np.uint32)


class Subtree:
    """A trie of letter counts whose leaves are ranges of words."""

    def __init__(self, entries: list[tuple[str, int]]):
        placed = sorted((vector(word), word, n) for word, n in entries)
        self.words, self.counts = [w for _, w, _ in placed], [n for _, _, n in placed]
        self.halves = {less: _halves(self.words, less) for less in (0, 1)}
        self.root: dict = {}
        for place, (counts, _, _) in enumerate(placed):
            node = self.root
            for count in counts[:-1]:
                node = node.setdefault(count, {})
            node[counts[-1]] = (node[counts[-1]][0] if counts[-1] in node else place, place + 1)

    def leaves(self, word: str) -> list[tuple[int, int, int]]:
        """The ranges of words at the leaves that one surplus and one deficit can reach, and how many
        letters more than ``word`` these have."""
        counts, found = vector(word), []
        stack = [(self.root, 0, 1, 1)]
        while stack:
            node, level, surplus, deficit = stack.pop()
            if level == GROUPS:
                found.append((*node, deficit - surplus))
                continue
            count = counts[level]
            level += 1
            if (child := node.get(count)) is not None:
                stack.append((child, level, surplus, deficit))
            if surplus and (child := node.get(count + 1)) is not None:
                stack.append((child, level, 0, deficit))
            if deficit and count and (child := node.get(count - 1)) is not None:
                stack.append((child, level, surplus, 0))
        return found

    def near(self, queries: list[str]) -> Iterator[tuple[int, int]]:
        """Places of a query and of a near word of it."""
        ranges, owners = [], []
        for k, word in enumerate(queries):
            found = self.leaves(word)
            ranges += found
            owners += [k] * len(found)
        spans, owner = np.array(ranges, np.int64).reshape(-1, 3), np.array(owners, np.int64)
        for more in (-1, 0, 1):
            here = spans[:, 2] == more
            if not here.any():
                continue
            starts, sizes = spans[here, 0], spans[here, 1] - spans[here, 0]
            into = np.cumsum(sizes) - sizes
            places = np.repeat(starts - into, sizes) + np.arange(int(sizes.sum()))
            mine = _halves(queries, int(more < 0))[owner[here]]
            # one edit leaves the first or the last half of the shorter word as it is
            differ = np.repeat(mine, sizes) ^ self.halves[int(more > 0)][places]
            likely = np.flatnonzero((differ & 0xFFFF == 0) | (differ >> 16 == 0))
            asked = owner[here][np.searchsorted(into, likely, "right") - 1]
            for k, place in zip(asked.tolist(), places[likely].tolist()):
                if one_edit(queries[k], self.words[place]):
                    yield k, place


# --- all words --------------------------------------------------------------------------

def _vectors(words: DataFrame) -> DataFrame:
    letters = "split(word, '')"
    counts = F.expr(f"transform(sequence(0, {GROUPS - 1}), g -> size(filter({letters}, c -> c <> '' AND ascii(c) % {GROUPS} = g)))")
    return words.withColumn("counts", counts)


def _homes(words: DataFrame) -> DataFrame:
    """``branch, parts, word, n, home`` of all words and the subtrees (with their parts) to search for them.

    ``home`` marks the subtree in which the word lives itself.
    """
    total = words.count()
    ahead = _vectors(words).select("word", "n", "counts", F.lit("").alias("branch"), F.lit(1).alias("surplus"),
                                   F.lit(1).alias("deficit"), F.lit(True).alias("home"))
    ahead = stage(ahead, "vectors")
    arrived = []
    for level in range(GROUPS + 1):
        if level:
            sizes = stage(ahead.where("home").groupBy("branch").agg(F.count(F.lit(1)).alias("size")), "branches")
            largest = sizes.agg(F.max("size")).first()[0] or 0
            met = ahead.join(sizes, "branch")
        else:
            largest, met = total, ahead.withColumn("size", F.lit(total).cast("bigint"))
        small = F.col("size") <= (SUBTREE if level < GROUPS else 2**62)
        parts = F.ceil(F.col("size") / SUBTREE).cast("int") if level == GROUPS else F.lit(1)
        arrived.append(met.where(small).select("branch", parts.alias("parts"), "word", "n", "home"))
        if level == GROUPS or largest <= SUBTREE:
            break
        steps = F.filter(F.array(*[F.struct(F.lit(d).alias("d")) for d in (0, 1, -1)]),
                         lambda s: (s["d"] == 0) | ((s["d"] == 1) & (F.col("surplus") == 1))
                         | ((s["d"] == -1) & (F.col("deficit") == 1) & (F.col("counts")[level] > 0)))
        further = met.where(~small).withColumn("step", F.explode(steps)).withColumn("d", F.col("step.d"))
        ahead = stage(further.select(
            "word", "n", "counts", F.concat_ws(".", "branch", (F.col("counts")[level] + F.col("d")).cast("string")).alias("branch"),
            (F.col("surplus") - (F.col("d") == 1).cast("int")).alias("surplus"),
            (F.col("deficit") - (F.col("d") == -1).cast("int")).alias("deficit"),
            (F.col("home") & (F.col("d") == 0)).alias("home")), "branches")
    found = arrived[0]
    for more in arrived[1:]:
        found = found.unionByName(more)
    return stage(found, "subtrees")


def _meetings(homes: DataFrame) -> DataFrame:
    """``spot, query, home, word, n``: a spot holds a part of a subtree and a block of the words that search it."""
    blocks = stage(homes.groupBy("branch").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
                                               F.max("parts").alias("all_parts")), "spots")
    met = homes.join(blocks, "branch")
    hashed = F.xxhash64("word")
    entries = (met.where("home").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
               .select("branch", F.pmod(hashed, "all_parts").alias("part"), F.col("block").cast("bigint").alias("block"),
                       F.lit(0).alias("query"), F.lit(False).alias("home"), "word", "n"))
    queries = (met.withColumn("part", F.explode(F.expr("sequence(0, all_parts - 1)")))
               .select("branch", F.col("part").cast("bigint").alias("part"), F.pmod(hashed, "blocks").alias("block"), F.lit(1).alias("query"),
                       (F.col("home") & (F.col("part") == F.pmod(hashed, "all_parts"))).alias("home"), "word", "n"))
    spots = entries.unionByName(queries).withColumn("spot", F.concat_ws("/", "branch", "part", "block"))
    return (spots.select("spot", "query", "home", "word", "n").repartition(task_slots(homes.sparkSession), "spot")
            .sortWithinPartitions("spot", "query"))


def _searched(rows: Iterator[tuple]) -> Iterator[tuple[Subtree, list[tuple[str, int, bool]]]]:
    """Subtrees with batches of queries, from rows ordered by spot, entries first."""
    at, entries, tree, batch = None, [], None, []
    for spot, query, home, word, n in rows:
        if spot != at:
            if batch:
                yield tree, batch
            at, entries, tree, batch = spot, [], None, []
        if not query:
            entries.append((word, n))
            continue
        if tree is None:
            tree, entries = Subtree(entries), []
        batch.append((word, n, home))
        if len(batch) == BATCH:
            yield tree, batch
            batch = []
    if batch:
        yield tree, batch


_BEST = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])
_LINKS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _prepared(words: DataFrame) -> DataFrame:
    kept = words.select(F.col("word").cast("string").alias("word"), F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n"))
    return stage(kept.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n")), "words")


def links(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n`` for all near pairs of ``words`` (``word, n``), from either side."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(_LINKS)
        for tree, batch in _searched(rows_of(batches)):
            for k, place in tree.near([word for word, _, _ in batch]):
                if sink.add((*batch[k][:2], tree.words[place], tree.counts[place])):
                    yield sink.flush()
        yield sink.flush()

    return _meetings(_homes(_prepared(words))).mapInArrow(search, "word string, n bigint, near string, near_n bigint")


def nearest(words: DataFrame) -> DataFrame:
    """``word, n, n_near, best, best_n`` for each of ``words`` (``word, n``): how many near words it has,
    and the most frequent one."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(_BEST)
        for tree, batch in _searched(rows_of(batches)):
            best: list = [None] * len(batch)
            number = [0] * len(batch)
            for k, place in tree.near([word for word, _, _ in batch]):
                number[k] += 1
                mine = (-tree.counts[place], tree.words[place])
                best[k] = mine if best[k] is None else min(best[k], mine)
            for (word, n, home), met, found in zip(batch, number, best):
                if home or met:
                    if sink.add((word, n, met, found and found[1], found and -found[0])):
                        yield sink.flush()
        yield sink.flush()

    met = _meetings(_homes(_prepared(words))).mapInArrow(search, "word string, n bigint, n_near bigint, best string, best_n bigint")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    return (met.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("found"))
            .select("word", "n", "n_near", F.col("found.best").alias("best"), (-F.col("found.less")).alias("best_n")))


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for each of ``words`` (``word, n``).

    ``form`` is the most frequent near word if it is ``ratio`` times as frequent; ``root`` is where the
    forms of forms end. Counts grow along forms, so they never go in circles (``ratio`` is 2 or more;
    a word of no occurrences has no form).
    """
    counted = F.col("best").isNotNull() & (F.col("best_n") >= ratio * F.col("n")) & (F.col("best_n") > F.col("n"))
    found = stage(nearest(words).select("word", "n", "n_near", F.when(counted, F.col("best")).alias("form"),
                                        F.when(counted, F.col("best_n")).alias("form_n")), "forms")
    ends = stage(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("end")), "ends")
    while True:  # each round doubles the steps taken
        onward = ends.select(F.col("word").alias("end"), F.col("end").alias("beyond"))
        step = stage(ends.join(onward, "end", "left").select("word", F.coalesce("beyond", "end").alias("end"),
                                                             F.col("beyond").isNotNull().alias("moved")), "ends")
        ends = step.select("word", "end")
        if step.where("moved").limit(1).count() == 0:
            break
    return found.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("end", "word").alias("root"))
