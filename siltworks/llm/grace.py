"""Exact removal of repeated texts by Grace hashing.

Method. Every task first passes its rows through a table of bounded size, so that of equal texts
met in one task one record goes on (this thins out a text that fills a third of all rows before
anything is shuffled). These records are dealt into as many buckets as there are shuffle
partitions, by a hash of the text. A bucket's task keeps an open-addressing table that compares
complete texts. When a bucket outgrows its memory, further texts that are not in the table are
spilled to files in the shared folder, cut by further bits of the hash, and each such file is
dealt with in the same way, as deep as needed. A row then learns its group from its task's record.

Two texts are equal when they are identical without white space (``[\\x20\\x09-\\x0D]``). Of equal
texts the one with the most code points stays, then the one with the smallest id.

Defined cases: null text counts as empty, and empty texts are equal to each other; rows without id
come last among equals (their ``keep_id`` is null only if all ids of the group are); repeated rows
each give a row, and those that share the id that stays are all ``kept``; an empty table gives an
empty table; further columns are ignored. Memory holds one table and one text of any length.
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_batches, scratch_path, stage
from ..sources.files import arrow_location
from .common import Sink, give_back, rows_of, whole_text
from .idfilter import split

BLANKS = b" \t\n\x0b\x0c\r"
TASK_TABLE_BYTES = 48 << 20
BUCKET_BYTES = 160 << 20
FANOUT = 16


class OpenTable:
    """Texts by open addressing with linear probing; equal hashes are settled by comparing texts."""

    def __init__(self):
        self.slots: list[int] = [-1] * 64
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.bytes = 0

    def find(self, digest: int, text: bytes) -> int:
        """The entry of a text, or -1."""
        mask = len(self.slots) - 1
        at = digest & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == digest and self.texts[entry] == text:
                return entry
            at = at + 1 & mask
        return -1

    def add(self, digest: int, text: bytes) -> int:
        """A new entry; the caller has found that there is none."""
        entry = len(self.texts)
        self.hashes.append(digest)
        self.texts.append(text)
        self.bytes += len(text) + 200
        if 3 * len(self.texts) > 2 * len(self.slots):
            self.slots = [-1] * (4 * len(self.slots))
            for known, h in enumerate(self.hashes):
                self._place(h, known)
        else:
            self._place(digest, entry)
        return entry

    def _place(self, digest: int, entry: int) -> None:
        mask = len(self.slots) - 1
        at = digest & mask
        while self.slots[at] >= 0:
            at = at + 1 & mask
        self.slots[at] = entry


def _better(one: tuple, other: tuple) -> tuple:
    """Of two (code points, id) the one that stays; without id last."""
    return min(one, other, key=lambda x: (-x[0], x[1] is None, x[1] or 0))


_PASS = pa.schema([("record", pa.string()), ("row_id", pa.int64()), ("text_sha256", pa.string()),
                   ("points", pa.int64()), ("size", pa.int64()), ("bucket", pa.int64()), ("body", pa.binary())])


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document naming its record, and the records: distinct texts of a table's span."""
    sink = Sink(_PASS)
    table, best, sizes, names, shas = OpenTable(), [], [], [], []

    def records():
        for entry, text in enumerate(table.texts):
            points, key = best[entry]
            if sink.add((names[entry], key, None, points, sizes[entry],
                         int.from_bytes(bytes.fromhex(shas[entry][:16]), "big", signed=True), text), len(text) + 128):
                yield sink.flush()

    for key, text in rows_of(batches):
        raw = (text or "").encode("utf-8", "surrogatepass")
        body = raw.translate(None, BLANKS)
        sha = hashlib.sha256(body).hexdigest()
        digest = int(sha[:15], 16)
        entry = table.find(digest, body)
        mine = (len(text or ""), key)
        if entry < 0:
            if table.bytes > TASK_TABLE_BYTES:
                yield from records()
                table, best, sizes, names, shas = OpenTable(), [], [], [], []
            table.add(digest, body)
            best.append(mine)
            sizes.append(1)
            names.append(uuid.uuid4().hex)
            shas.append(sha)
            entry = len(names) - 1
        else:
            best[entry] = _better(best[entry], mine)
            sizes[entry] += 1
        if sink.add((names[entry], key, sha, len(text or ""), None, None, None), 160):
            yield sink.flush()
    yield from records()
    yield sink.flush()
    del table, best, sizes, names, shas
    give_back()


_GROUP = pa.schema([("record", pa.string()), ("keep_id", pa.int64()), ("keep_points", pa.int64()),
                    ("group_size", pa.int64())])
_SPILL = pa.schema([("record", pa.string()), ("row_id", pa.int64()), ("points", pa.int64()),
                    ("size", pa.int64()), ("bucket", pa.int64()), ("body", pa.binary())])


class Bucket:
    """One bucket's groups: a table while memory lasts, spill files for the rest."""

    def __init__(self, folder: str, memory: int = BUCKET_BYTES, fanout: int = FANOUT):
        self.folder, self.memory, self.fanout = folder, memory, fanout
        self.spilled = 0

    def groups(self, records: Iterator[tuple], depth: int = 0) -> Iterator[tuple]:
        """``record, keep_id, keep_points, group_size`` of every record."""
        table, best, sizes, names, writers = OpenTable(), [], [], [], {}
        held = 0
        for name, key, points, size, spread, body in records:
            digest = spread & (1 << 60) - 1
            entry = table.find(digest, body)
            if entry >= 0:
                best[entry] = _better(best[entry], (points, key))
                sizes[entry] += size
                names[entry].append(name)
                held += 100
            elif table.bytes + held < self.memory or not table.texts:
                table.add(digest, body)
                best.append((points, key))
                sizes.append(size)
                names.append([name])
            else:
                self._spill(writers, depth, (name, key, points, size, spread, body))
        for (points, key), size, members in zip(best, sizes, names):
            for name in members:
                yield name, key, points, size
        del table, best, sizes, names
        paths = [writer.close() for writer in writers.values()]
        for path in paths:
            yield from self.groups(self._read(path), depth + 1)

    def _spill(self, writers: dict, depth: int, record: tuple) -> None:
        spread = (record[4] & (1 << 64) - 1) * 0x9E3779B97F4A7C15 + depth & (1 << 64) - 1
        part = (spread >> 56 - 4 * (depth % 12)) % self.fanout
        if part not in writers:
            writers[part] = SpillFile(f"{self.folder}/{uuid.uuid4().hex}-{depth}-{part}.arrow")
            self.spilled += 1
        writers[part].add(record)

    def _read(self, path: str) -> Iterator[tuple]:
        filesystem, name = arrow_location(path)
        with filesystem.open_input_file(name) as source:
            reader = pa.ipc.open_file(source)
            for k in range(reader.num_record_batches):
                yield from rows_of([reader.get_batch(k)])
        filesystem.delete_file(name)


class SpillFile:
    """Records in an Arrow file of the shared folder."""

    def __init__(self, path: str):
        self.path, self.sink = path, Sink(_SPILL)
        filesystem, name = arrow_location(path)
        filesystem.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.stream = filesystem.open_output_stream(name)
        self.writer = pa.ipc.new_file(self.stream, _SPILL, options=pa.ipc.IpcWriteOptions(compression="lz4"))

    def add(self, record: tuple) -> None:
        if self.sink.add(record, FANOUT * len(record[5]) + 64):  # all open files together hold one sink's bytes
            self.writer.write_batch(self.sink.flush())

    def close(self) -> str:
        self.writer.write_batch(self.sink.flush())
        self.writer.close()
        self.stream.close()
        return self.path


def exact_groups(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``<id>, keep_id, group_size, kept, text_sha256`` of every row."""
    spark = df.sparkSession
    bounded_batches(spark)
    rows = df.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
    passed = stage(rows.mapInArrow(_first_pass, "record string, row_id bigint, text_sha256 string, points bigint, "
                                                "size bigint, bucket bigint, body binary"), "grace")
    folder = scratch_path(spark, "grace-spill")

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(_GROUP)
        for row in Bucket(folder, bucket_bytes).groups(rows_of(batches)):
            if sink.add(row, 80):
                yield sink.flush()
        yield sink.flush()
        give_back()

    records = (passed.where(F.col("body").isNotNull())
               .select("record", "row_id", "points", "size", "bucket", "body")
               .repartition(_buckets(spark), "bucket")
               .mapInArrow(bucket, "record string, keep_id bigint, keep_points bigint, group_size bigint"))
    members = passed.where(F.col("text_sha256").isNotNull()).select("record", "row_id", "points", "text_sha256")
    joined = members.join(records, "record")
    stays = F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    return joined.select(F.col("row_id").alias(id_column), "keep_id", "group_size", stays.alias("kept"), "text_sha256",
                         F.col("points").alias("n_points"))


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_best(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; of repeated rows one."""
    found = stage(exact_groups(df, id_column, text_column), "groups")
    key = F.col(id_column)
    repeated = found.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(id_column)
    gone = stage(found.where(~F.col("kept")).select(id_column).union(repeated), "gone")
    # ids all of whose rows stay need no join; those in doubt are few, and meet their groups
    rest, doubt = split(df, id_column, gone)
    nulls, rest = rest.where(key.isNull()), rest.where(key.isNotNull())
    doubt = doubt.unionAll(nulls)
    body = whole_text(text_column)
    # all columns travel in one struct, so that no name can clash
    marked = doubt.select(key.cast("bigint").alias("own_id"), F.sha2(F.regexp_replace(body, "[\\x20\\x09-\\x0D]+", ""), 256).alias("own_sha"),
                          F.length(body).cast("bigint").alias("own_points"), F.struct("*").alias("row"))
    stay = found.where("kept").select(key.alias("id"), F.col("text_sha256").alias("sha"), F.col("n_points").alias("points"))
    kept = marked.join(stay, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_sha") == F.col("sha"))
                       & (F.col("own_points") == F.col("points")), "left_semi").dropDuplicates(["own_sha"])
    return rest.unionAll(kept.select("row.*"))
