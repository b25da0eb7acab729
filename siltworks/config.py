"""Configuration objects handed to the jobs in :mod:`siltworks.plans`."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any, Mapping, NamedTuple, Sequence

FILES_PER_BATCH = 10_000

# Where the parts of a landed table lie, as jobs that share tables expect them.
LANDED = "{landing}/{table}/"
BRONZE = "{catalog}.{schema}.{table}{suffix}"
ORIGIN = "{source}.{table}"
STATE = "{state}/{source}/{table}"
DEFAULT_STATE = "{above}/_checkpoints/{schema}"


class TableLayout(NamedTuple):
    """Names and places of one landed table."""

    landed: str
    bronze: str
    origin: str
    state: str

    @property
    def schemas(self) -> str:
        """Where the schema versions of the landed files are kept."""
        return self.state + "/_schema"


@dataclass(frozen=True)
class Reading:
    """How landed files are read: one value for finding their schema and for streaming them.

    ``rescue`` keeps values that do not fit their column, whatever types later files bring, in
    ``_rescued_data``; text formats always do. Without it a file of other types stops its table.
    With ``evolve=False`` a known schema is used as it is, and new columns are left out.
    ``files_per_batch`` bounds the work that a lost micro-batch repeats.
    """

    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    rescue: bool = False
    evolve: bool = True
    files_per_batch: int = FILES_PER_BATCH

    @property
    def all_options(self) -> dict[str, str]:
        return {**({"header": "true"} if self.format == "csv" else {}), **self.options}

    @property
    def rescues(self) -> bool:
        return self.rescue or self.format in ("csv", "json")


@dataclass(frozen=True)
class Landing:
    """A folder of change files with one folder for each table, and the schema of their bronze tables.

    State goes beside the landing folder unless ``state`` says where. ``row_order`` adds each row's
    position in its file (Parquet only): with the dated file path it orders changes that carry no
    sequence of their own.
    """

    folder: str
    source: str
    schema: str
    catalog: str = "spark_catalog"
    suffix: str = "_raw"
    state: str | None = None
    row_order: bool = False
    reading: Reading = Reading()

    def layout(self, table: str) -> TableLayout:
        folder = self.folder.rstrip("/")
        state = self.state or DEFAULT_STATE.format(above=folder.rpartition("/")[0], schema=self.schema)
        names = {"table": table, "landing": folder, "source": self.source, "schema": self.schema,
                 "catalog": self.catalog, "suffix": self.suffix, "state": state.rstrip("/")}
        return TableLayout(*(pattern.format(**names) for pattern in (LANDED, BRONZE, ORIGIN, STATE)))


@dataclass(frozen=True)
class FileEntry:
    """One file name or wildcard of a domain and the table it feeds."""

    name: str
    table: str
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class DomainConfig:
    """Files of one domain, the schema their tables live in, and the write mode."""

    source_path: str
    target_schema: str
    files: Sequence[FileEntry]
    mode: str = "append"
    skip_seen: bool = False

    @classmethod
    def from_dict(cls, source_path: str, target_schema: str, config: Mapping[str, Any] | str,
                  mode: str = "append", skip_seen: bool = False) -> "DomainConfig":
        """Accept ``{"filenames": [{"name": ..., "table": ...}]}`` as a dict or JSON text."""
        parsed = json.loads(config) if isinstance(config, str) else config
        files = [FileEntry(f["name"], f["table"], f.get("options", {})) for f in parsed["filenames"]]
        return cls(source_path, target_schema, files, mode, skip_seen)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    comment: str = ""


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: Sequence[ColumnSpec]
    comment: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class CheckSpec:
    """What to check on one table; ``layer`` picks the set of checks.

    A bronze table is observed (freshness, volume, drift, duplicate arrivals); a silver table
    must conform (required columns, keys, rules).
    """

    table: str
    layer: str
    freshness_sla: str | None = None
    volume_tolerance: float | None = None
    primary_keys: Sequence[str] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    required: Sequence[str] = ()
    expected_columns: Sequence[str] = ()
    ingest_column: str = "_ingest_ts"
    baseline_runs: int = 7

    def __post_init__(self) -> None:
        if self.layer not in ("bronze", "silver"):
            raise ValueError(f"layer of {self.table} must be bronze or silver, not {self.layer!r}")
