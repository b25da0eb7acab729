"""Members of zip archives, unpacked by the executors."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import _qualified, arrow_location

_BATCH_BYTES = 8 << 20
MEMBER_SCHEMA = "archive string, entry string, content binary"
LINE_SCHEMA = "archive string, entry string, line_no bigint, line string"


def _archives(spark: SparkSession, path: str, name_glob: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", name_glob).load(path).select("path", "content"))


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, zipfile.ZipFile, zipfile.ZipInfo]]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for info in archive.infolist():
                    if not info.is_dir():
                        yield path, archive, info


def archive_members(spark: SparkSession, path: str, name_glob: str = "*.zip") -> DataFrame:
    """``archive, entry, content`` of every member, one member in memory at a time."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for archive_path, archive, info in _members(batches):
            yield pd.DataFrame({"archive": [archive_path], "entry": [info.filename],
                                "content": [archive.read(info)]})

    return _archives(spark, path, name_glob).mapInPandas(unpack, MEMBER_SCHEMA)


def archive_lines(spark: SparkSession, path: str, name_glob: str = "*.zip",
                  encoding: str = "utf-8") -> DataFrame:
    """``archive, entry, line_no, line`` of text members, inflated as a stream in batches."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for archive_path, archive, info in _members(batches):
            with archive.open(info) as raw:
                reader = io.TextIOWrapper(raw, encoding=encoding, newline=None)
                lines, size, first = [], 0, 0
                for line in reader:
                    lines.append(line.rstrip("\n"))
                    size += len(line)
                    if size >= _BATCH_BYTES:
                        yield _line_batch(archive_path, info.filename, first, lines)
                        first, lines, size = first + len(lines), [], 0
                if lines:
                    yield _line_batch(archive_path, info.filename, first, lines)

    return _archives(spark, path, name_glob).mapInPandas(unpack, LINE_SCHEMA)


def _line_batch(archive: str, entry: str, first: int, lines: list[str]) -> pd.DataFrame:
    return pd.DataFrame({"archive": archive, "entry": entry,
                         "line_no": range(first, first + len(lines)), "line": lines})


def parse_csv_lines(lines: DataFrame, schema: T.StructType, header: bool = True) -> DataFrame:
    """Turn :func:`archive_lines` of CSV members into typed columns, inside the JVM.

    Every record is one line; a quoted field with a line break needs the extracted file.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    body = lines.where("line_no > 0") if header else lines
    parsed = body.select("archive", "entry", F.from_csv("line", columns).alias("r"))
    return parsed.select("archive", "entry", "r.*")


def _parts(archive: str, entry: str) -> list[str]:
    parts = [p for p in entry.replace("\\", "/").split("/") if p not in ("", ".")]
    if ".." in parts:
        raise ValueError(f"{entry} of {archive} points outside its archive")
    return parts


def extract_members(spark: SparkSession, path: str, landing: str,
                    name_glob: str = "*.zip") -> DataFrame:
    """Write every member to ``landing`` and return ``archive, entry, written_to, bytes``.

    Of members with the same path in several archives, that of the first archive in path order goes
    to its path, and the others below the path of their archive as seen from ``path``. Runs when the
    result is read; archives are listed first. Members are copied in small blocks. A member is written
    under a temporary name and then renamed, so a repeated task leaves one whole file.
    """
    root = _qualified(spark, path).rstrip("/") + "/"

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for archive_path, _, info in _members(batches):
            yield pd.DataFrame({"path": [archive_path], "entry": ["/".join(_parts(archive_path, info.filename))]})

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = arrow_location(landing)
        for batch in batches:
            others = {p: frozenset(() if m is None else m) for p, m in zip(batch["path"], batch["moved"])}
            for archive_path, archive, info in _members(iter([batch])):
                parts = _parts(archive_path, info.filename)
                if "/".join(parts) in others[archive_path]:
                    parts = [p for p in archive_path.removeprefix(root).split("/") if p] + parts
                final = "/".join([base.rstrip("/"), *parts])
                partial = f"{os.path.dirname(final)}/.{uuid.uuid4().hex}.part"
                target.create_dir(os.path.dirname(final), recursive=True)
                with archive.open(info) as source, target.open_output_stream(partial) as sink:
                    while block := source.read(_BATCH_BYTES):
                        sink.write(block)
                target.move(partial, final)
                yield pd.DataFrame({"archive": [archive_path], "entry": [info.filename],
                                    "written_to": [final], "bytes": [info.file_size]})

    archives = _archives(spark, path, name_glob)
    names = archives.mapInPandas(entries, "path string, entry string")
    first = names.groupBy("entry").agg(F.min("path").alias("first"))
    moved = (names.join(first, "entry").where("path > first")
             .groupBy("path").agg(F.collect_set("entry").alias("moved")))
    return archives.join(moved, "path", "left").select("path", "content", "moved").mapInPandas(
        unpack, "archive string, entry string, written_to string, bytes bigint")
