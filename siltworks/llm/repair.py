"""Token ids of a corpus in binary files, compressed by a grammar, with random access.

Method. Documents are dealt out by ranges of their id and sorted, so that files follow each other in
ascending order of ids. A task encodes its documents with the tokenizer library, appends the end
id, and cuts the stream into shards of about ``SHARD_IDS`` ids. Each shard is compressed by Re-Pair:
frequent pairs of neighbouring ids are replaced by new ids (nonterminals), again and again. A round takes
all pairs that occur as often as its threshold, the more frequent one where two overlap; the next round's
threshold is a quarter, down to ``LEAST``, at which rounds go on while they remove 0.5 % of the symbols.
Pairs don't reach over the end of a document.
The file holds the rules with the number of ids that each stands for, and where every document
begins in symbols and in ids, so that a document or a range of ids is decoded alone.

Tokenizing. The library's splitter never joins over white space, and its normalizer works on each
side of it alone, so a text is encoded run by run between white space, and the ids of runs met before
are kept in a table of bounded size. Signs behind a word are a run of their own, as no token holds
letters and signs. The library itself encodes every run that isn't in the table.

Files are written below one folder; a table with one row per file says which of them count (a task
that was repeated leaves files that no row names). ``start`` positions come from the sizes of files.

Defined cases: null text counts as empty, an empty text has the end id only; rows without id come
first, repeated ids follow each other in the order of their texts, each row being a document of its own;
an empty table gives no files and an empty table; further columns of any name are ignored. Texts may
have any length: a document is never cut, so a shard is at least one document, and memory holds one shard.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, task_slots
from ..sources.files import arrow_location
from .common import Sink, per_process, rows_of, whole_text

SHARD_IDS = 1 << 19
#: Pairs that occur less often in a shard get no rule.
LEAST = 8
END_ID = 2
MAGIC = b"SILTGRM1"


# --- grammar ----------------------------------------------------------------------------

_BUCKETS = 18
_NEVER = np.int32(2**31 - 1)


def _frequent(symbols: np.ndarray, inner: np.ndarray, total: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that occur ``least`` times, most frequent first, the places of all of them, and the rank of each place's pair."""
    if total < 1 << 16:
        pair = symbols[:-1].astype(np.uint32) * np.uint32(total) + symbols[1:].astype(np.uint32)
        bucket = pair * np.uint32(0x9E3779B1) >> np.uint32(32 - _BUCKETS)
    else:
        pair = symbols[:-1].astype(np.uint64) * np.uint64(total) + symbols[1:].astype(np.uint64)
        bucket = pair * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _BUCKETS)
    bucket = bucket.astype(np.intp)
    counts = np.bincount(bucket, minlength=1 << _BUCKETS)
    counts -= np.bincount(bucket[~inner], minlength=1 << _BUCKETS)  # ends of documents are few
    places = np.flatnonzero((counts >= least)[bucket] & inner)  # a bucket's count is no less than its pairs'
    found, which, n = np.unique(pair[places], return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] >= least]
    rank_of = np.full(len(found), _NEVER, np.int32)
    rank_of[order] = np.arange(len(order), dtype=np.int32)
    ranks = rank_of[which]
    hit = ranks != _NEVER
    return found[order], places[hit], ranks[hit]


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur, ascending, and for each id its place among them."""
    if len(ids) and int(ids.max()) > 8 * len(ids) + (1 << 16):
        return np.unique(ids, return_inverse=True)
    occurs = np.zeros(int(ids.max()) + 1 if len(ids) else 0, bool)
    occurs[ids] = True
    return np.flatnonzero(occurs).astype(ids.dtype), (np.cumsum(occurs, dtype=np.int32) - 1)[ids]


def compress(ids: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of one shard.

    ``ends`` marks the last id of each document. Returns terminals (the ids that occur), rules
    (two symbols each; symbols count on from the terminals), symbols, and the marks of their ends.
    """
    terminals, symbols = _numbered(ids)
    symbols, ends = symbols.astype(np.int32), ends.copy()
    rules, total = [], len(terminals)
    threshold = max(least, len(symbols) >> 10)
    while len(symbols) > 1:
        pairs, places, ranks = _frequent(symbols, ~ends[:-1], total, threshold)
        removed = 0
        if len(pairs):
            # where pairs overlap the more frequent one wins; in a run of one symbol every other pair
            beside = np.diff(places) == 1
            wins = np.ones(len(places), bool)
            wins[1:] &= ~beside | (ranks[1:] <= ranks[:-1])
            wins[:-1] &= ~beside | (ranks[:-1] <= ranks[1:])
            taken, ranks = places[wins], ranks[wins]
            number = np.arange(len(taken))
            first = np.maximum.accumulate(np.where(np.diff(taken, prepend=-2) != 1, number, 0))
            every = (number - first) % 2 == 0
            taken, ranks = taken[every], ranks[every]
            used = np.bincount(ranks, minlength=len(pairs))
            worth = used >= least
            stays = worth[ranks]
            taken, ranks = taken[stays], ranks[stays]
            number = np.cumsum(worth) - 1
            removed = len(taken)
            symbols[taken] = total + number[ranks]
            ends[taken] = ends[taken + 1]
            keep = np.ones(len(symbols), bool)
            keep[taken + 1] = False
            rules.append(np.stack(np.divmod(pairs[worth], pairs.dtype.type(total)), 1).astype(np.int32))
            symbols, ends = symbols[keep], ends[keep]
            total += int(worth.sum())
        if threshold > least:
            threshold = max(least, threshold >> 2)
        elif 200 * removed <= len(symbols):
            break
    return terminals, np.concatenate(rules) if rules else np.empty((0, 2), np.int32), symbols, ends


class Grammar:
    """Expands symbols; ``lengths`` says how many ids each stands for."""

    def __init__(self, terminals: np.ndarray, rules: np.ndarray):
        base = len(terminals)
        self.starts = np.arange(base + len(rules), dtype=np.int64)
        self.lengths = np.ones(base + len(rules), np.int64)
        self.table = terminals.astype(np.uint32)
        ready = np.arange(base + len(rules)) < base
        waiting = np.arange(len(rules))
        while len(waiting):  # rules whose parts are known, a layer at a time
            now = waiting[ready[rules[waiting, 0]] & ready[rules[waiting, 1]]]
            if not len(now):
                raise ValueError("the rules of the grammar go in circles")
            sizes = self.lengths[rules[now, 0]] + self.lengths[rules[now, 1]]
            self.starts[base + now] = len(self.table) + np.cumsum(sizes) - sizes
            self.table = np.concatenate((self.table, self.expand(rules[now].reshape(-1))))
            self.lengths[base + now] = sizes
            ready[base + now] = True
            waiting = waiting[~ready[base + waiting]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.lengths[symbols]
        into = np.cumsum(sizes) - sizes
        return self.table[np.repeat(self.starts[symbols] - into, sizes) + np.arange(int(sizes.sum()))]


# --- file -------------------------------------------------------------------------------

_HEAD = "<8s5Q"


def pack(keys: list, ids: list[np.ndarray], least: int = LEAST) -> bytes:
    """A shard's file: header, then arrays in the order of :class:`Shard`, then a crc32. Documents
    have at least one id each."""
    sizes = np.array([len(x) for x in ids], np.int64)
    stream = np.concatenate(ids)
    ends = np.zeros(len(stream), bool)
    ends[np.cumsum(sizes) - 1] = True
    terminals, rules, symbols, marks = compress(stream, ends, least)
    narrow = len(terminals) + len(rules) <= 1 << 16
    lengths = Grammar(terminals, rules).lengths[len(terminals):]
    body = b"".join((
        np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([k is None for k in keys], "u1").tobytes(),
        np.concatenate(([0], np.flatnonzero(marks) + 1)).astype("<u8").tobytes(),
        np.concatenate(([0], np.cumsum(sizes))).astype("<u8").tobytes(),
        terminals.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u8").tobytes(),
        symbols.astype("<u2" if narrow else "<u4").tobytes()))
    head = struct.pack(_HEAD, MAGIC, len(keys), len(terminals), len(rules), len(symbols), len(stream))
    return head + body + struct.pack("<I", zlib.crc32(body, zlib.crc32(head)))


class Shard:
    """A file read back. ``keys``, ``starts`` (of documents in ids, and the end) and decoding by place."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, n, n_terminals, n_rules, n_symbols, self.n_ids = struct.unpack_from(_HEAD, view)
        if magic != MAGIC or struct.unpack("<I", view[-4:])[0] != zlib.crc32(view[:-4]):
            raise ValueError("a shard of token ids is damaged")
        at = struct.calcsize(_HEAD)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(view, kind, count, at)
            at += found.nbytes
            return found

        keys, absent = take("<i8", n), take("u1", n)
        self.keys = [None if gone else int(k) for k, gone in zip(keys, absent)]
        self.places, self.starts = take("<u8", n + 1).astype(np.int64), take("<u8", n + 1).astype(np.int64)
        terminals, rules = take("<u4", n_terminals), take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        lengths = take("<u8", n_rules)
        self.symbols = take("<u2" if n_terminals + n_rules <= 1 << 16 else "<u4", n_symbols).astype(np.int64)
        self.grammar = Grammar(terminals, rules)
        if not np.array_equal(self.grammar.lengths[n_terminals:], lengths.astype(np.int64)):
            raise ValueError("a shard's lengths disagree with its rules")

    def document(self, k: int) -> np.ndarray:
        return self.grammar.expand(self.symbols[self.places[k]:self.places[k + 1]])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids by place in the shard; only the symbols that reach into the range are expanded."""
        start, stop = max(0, start), min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        first = int(np.searchsorted(self.starts, start, "right")) - 1
        last = int(np.searchsorted(self.starts, stop, "left"))
        symbols = self.symbols[self.places[first]:self.places[last]]
        begins = self.starts[first] + np.concatenate(([0], np.cumsum(self.grammar.lengths[symbols])))
        a, b = int(np.searchsorted(begins, start, "right")) - 1, int(np.searchsorted(begins, stop, "left"))
        found = self.grammar.expand(symbols[a:b])
        return found[start - begins[a]:stop - begins[a]]


# --- tokenizing -------------------------------------------------------------------------

_RUN = re.compile(r"[^ \t\n\r]+")
#: White space of which it differs between libraries whether it is any.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Marks that make one letter with the one before them.
_MARKS = re.compile("[\u0300-\u036f]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A splitter with this pattern takes plain letters and plain signs apart, and its model gets them as they are.
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")
#: Signs that may follow a word and are no part of its tokens; special tokens must not end with one.
_SIGNS = "!\"#$%&()*+,-./:;<=?@[\\]^_`{|}~"
_LAST = "a-z0-9\xdf-\xf6\xf8-\xff"
#: Signs between a word's last letter and white space or the text's end.
_BEHIND = re.compile(rf"[{re.escape(_SIGNS)}](?<=[{_LAST}].)[{re.escape(_SIGNS)}]*(?![^ \t\n\r])")
_SMALL = {c: c + 32 for c in range(0xC0, 0xDF) if c != 0xD7}
LONGEST_KEPT, KEPT = 64, 400_000


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for
    itself, other bytes for the letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Encoder:
    """Ids of texts, run by run; ``KEPT`` runs of the current and of the last generation are kept."""

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        parts = json.loads(self.tokenizer.to_str())
        normalizer, splitter = parts["normalizer"] or {}, parts["pre_tokenizer"] or {}
        steps = [step["type"] for step in normalizer.get("normalizers", [normalizer]) if step]
        # a text's capital letters may be lowered before it is cut, as the library does so anyway
        self.lowers = steps == ["NFC", "Replace", "Lowercase"]
        self.splits = self.lowers and [p.get("pattern", {}).get("Regex") for p in splitter.get("pretokenizers", [])] == [_SPLITTER, None]
        special = [token["content"] for token in parts["added_tokens"]]
        self.signs = _SIGNS if self.splits and not any(token[-1] in _SIGNS or token.split() != [token] for token in special) else ""
        self.letters = _byte_letters()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        """The ids of a run that the current generation lacks."""
        found = self.old.get(run)
        if found is not None:
            return self._keep(run, found)
        word = run if run.isascii() else run.translate(_SMALL)
        if self.splits and _WORD.fullmatch(word):
            if not word.isascii():
                word = "".join([self.letters[b] for b in word.encode()])
            return self._keep(run, array("I", [token.id for token in self.model.tokenize(word)]).tobytes())
        return self._keep(run, array("I", self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes())

    def _keep(self, run: str, found: bytes) -> bytes:
        if len(run) <= LONGEST_KEPT:
            if len(self.new) >= KEPT:
                self.old, self.new = self.new, {}
            self.new[run] = found
        return found

    def ids(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        if self.lowers and not _MARKS.search(text):
            text = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
        if self.signs:  # letters and signs are never in one token, so words are kept without the signs behind them
            text = _BEHIND.sub(r" \g<0>", text)
        runs = _RUN.findall(text) if _ODD.search(text) else text.split()
        parts = list(map(self.new.get, runs))
        for k in [k for k, part in enumerate(parts) if part is None]:
            parts[k] = self.new.get(runs[k]) or self._run(runs[k])
        return b"".join(parts)


# --- tables -----------------------------------------------------------------------------

_FILES = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()),
                    ("n_ids", pa.int64()), ("bytes", pa.int64())])


def write(df: DataFrame, folder: str, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
          end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards below ``folder``; a row per file: ``path, first, n_docs, n_ids, bytes``, where
    ``first`` is the number of ids in all files before it."""
    end = np.array([end_id], "<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("repair", tokenizer_path), lambda: Encoder(tokenizer_path))
        filesystem, base = arrow_location(folder)
        filesystem.create_dir(base, recursive=True)
        part, sink, seq = TaskContext.get().partitionId(), Sink(_FILES), 0

        def save() -> tuple:
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.ids"
            data = pack(keys, ids)
            with filesystem.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            return part, seq, f"{folder}/{name}", len(keys), held, len(data)

        keys, ids, held = [], [], 0
        for key, text in rows_of(batches):
            found = np.frombuffer(encoder.ids(text) + end, "<u4")
            if keys and held + len(found) > shard_ids:
                sink.add(save())
                keys, ids, held, seq = [], [], 0, seq + 1
            keys.append(key)
            ids.append(found)
            held += len(found)
        if keys:
            sink.add(save())
        yield sink.flush()

    rows = df.select(F.col(id_column).cast("bigint").alias("key"), whole_text(text_column).alias("text"))
    sorted_rows = rows.repartitionByRange(task_slots(df.sparkSession), "key").sortWithinPartitions("key", "text")
    files = stage(sorted_rows.mapInArrow(shards, "part bigint, seq bigint, path string, n_docs bigint, n_ids bigint, bytes bigint"), "shards")
    # one row per slice of the range shuffle: the window over all of them is bounded by their number
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    earlier = parts.select("part", F.coalesce(F.sum("of_part").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    before = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.withColumn("before", before).join(F.broadcast(earlier), "part")
    return stage(placed.select("path", (F.col("before") + F.col("earlier")).alias("first"), "n_docs", "n_ids", "bytes"), "files")


def _shard(path: str) -> Shard:
    filesystem, name = arrow_location(path)
    with filesystem.open_input_file(name) as source:
        return Shard(source.read())


_READ = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``<id>, start, n_tokens, ids`` of every document of the files that :func:`write` named.

    ``ids`` are packed as little-endian 32-bit integers.
    """
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(_READ)
        for path, first in rows_of(batches):
            shard = _shard(path)
            for k, key in enumerate(shard.keys):
                ids = shard.document(k).astype("<u4").tobytes()
                if sink.add((key, first + int(shard.starts[k]), len(ids) // 4, ids), len(ids) + 64):
                    yield sink.flush()
        yield sink.flush()

    spread = files.select("path", "first").repartition(task_slots(files.sparkSession))
    found = spread.mapInArrow(documents, "key bigint, start bigint, n_tokens bigint, ids binary")
    return found.withColumnRenamed("key", id_column)


def read_range(files: DataFrame, start: int, stop: int) -> DataFrame:
    """``start, ids`` for each file that holds ids of the range ``start`` to ``stop`` of the whole corpus;
    only the symbols that reach into the range are expanded."""
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, first in rows_of(batches):
            found = _shard(path).ids(start - first, stop - first).astype("<u4").tobytes()
            yield pa.RecordBatch.from_pydict({"start": pa.array([max(start, first)], pa.int64()), "ids": pa.array([found], pa.binary())})

    wanted = files.where((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start)).select("path", "first")
    return wanted.mapInArrow(ranges, "start bigint, ids binary")
