r"""Secrets in texts: known shapes, and literals by the names that they are assigned to.

Method. A lexer reads source and configuration syntax into names and values: ``name = "literal"``,
``name := value``, ``"name": "value"``, ``name: value``, ``export NAME=value``, ``<name>value</name>``,
with literals joined by ``+``. The values of names are remembered, so that a name assigned to
another passes its literal on, as often as needed; a later assignment replaces an earlier one. A
value without quotes that is no known name is a literal itself. Each
literal gets a score: how sensitive its target's name is, how long and mixed its characters are,
and less if it looks like a placeholder. Literals that reach ``THRESHOLD`` are reported where they
stand, once. Besides, three shapes are found wherever they stand: assignments by a fixed list of
names, access keys and long hex runs (see ``SHAPES``), leftmost and without overlap for each.

Defined cases: null text counts as empty and has no secrets; repeated rows each give a row; an
empty table gives an empty table; further columns are ignored; whole texts of any length are read,
one in memory at a time. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import Iterator, NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Sink, rows_of, whole_text

THRESHOLD = 0.6

# Shapes by kind in the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "named")
# Words of names that hold secrets with their weights, and words that say the opposite.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
             "credential": 0.8, "credentials": 0.8, "auth": 0.6, "bearer": 0.8, "private": 0.6, "access": 0.5, "key": 0.5,
             "signing": 0.6, "encryption": 0.6, "salt": 0.5, "pin": 0.4, "dsn": 0.6, "api": 0.4, "session": 0.4}
HARMLESS = frozenset("name type file path url length count limit size field public id hint label policy".split())
PLACEHOLDERS = re.compile(r"(?i)^(?:x+|\*+|\.+|your.*|change.?me.*|example.*|placeholder.*|todo|none|null|true|false|<.*>|\$\{.*\}|%.*%|test|dummy|redacted)$")

_LEX = re.compile(r"""
    (?P<quote>["']?)(?<![A-Za-z0-9_.-])(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)(?P=quote)(?:[\x20\t]*\[[^\]\n]{0,80}\])?
    [\x20\t]*(?P<op>:=|=>|=(?![=~])|:(?![:/]))[\x20\t]*
    (?P<value>(?:[A-Za-z]{0,2}(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)(?:[\x20\t]*\+[\x20\t]*)?)+|[^\s"'`,;(){}\[\]<>]+)
  | <(?P<tag>[A-Za-z_][A-Za-z0-9_.-]*)>(?P<body>[^<>\n]+)</(?P=tag)>
""", re.X)
_STRING = re.compile(r""""((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`""")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Span(NamedTuple):
    start: int
    kind: str
    end: int


class Value(NamedTuple):
    """A literal's text and where its parts stand."""

    text: str
    places: tuple[tuple[int, int], ...]


def shapes(text: str) -> list[Span]:
    """The spans of the fixed shapes."""
    found = [Span(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [Span(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [Span(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def assignments(text: str) -> Iterator[tuple[str, Value, bool]]:
    """Names, what they are assigned, and whether that may be another name, as it stands without quotes."""
    if "=" not in text and ":" not in text and "</" not in text:
        return
    for match in _LEX.finditer(text):
        if match["tag"]:
            yield match["tag"], Value(match["body"], (match.span("body"),)), False
            continue
        first = match.start("value")
        raw = match["value"]
        strings = list(_STRING.finditer(raw))
        if strings:
            parts = [(m.lastindex, m) for m in strings]
            places = tuple((first + m.start(k), first + m.end(k)) for k, m in parts)
            yield match["name"], Value("".join(m[k] for k, m in parts), places), False
        else:
            raw = raw.rstrip(".,:")
            if raw:
                yield match["name"], Value(raw, ((first, first + len(raw)),)), True


def sensitivity(name: str) -> float:
    """How likely a name's value is a secret, by its words."""
    words = [w.lower() for w in _WORDS.findall(name)]
    if not words or words[-1] in HARMLESS:
        return 0.0
    joined = [a + b for a, b in zip(words, words[1:])]
    return min(1.0, sum(sorted((SENSITIVE.get(w, 0.0) for w in {*words, *joined}), reverse=True)[:2]))


def strength(literal: str) -> float:
    """From 0 to 1: long literals of many different characters score high, placeholders 0."""
    if len(literal) < 6 or PLACEHOLDERS.match(literal):
        return 0.0
    counts, size = Counter(literal), len(literal)
    entropy = -sum(c / size * math.log2(c / size) for c in counts.values())
    mixed = sum(any(map(test, literal)) for test in (str.isdigit, str.isupper, str.islower)) / 3
    if any(c.isspace() for c in literal):
        mixed /= 2
    return min(1.0, 0.5 * min(1.0, entropy / 3.5) + 0.2 * min(1.0, size / 16) + 0.3 * mixed)


def named(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """The spans of literals that reach sensitive names, straight or by other names."""
    known: dict[str, Value] = {}
    found: set[Span] = set()
    for name, value, bare in assignments(text):
        if bare:
            value = known.get(value.text, value)
        known[name] = value
        weight = sensitivity(name)
        if weight and weight * strength(value.text) >= threshold:
            found.update(Span(a, "named", b) for a, b in value.places if b > a)
    return sorted(found)


def _joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in ordered)


_SCAN = pa.schema([("row_key", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                   ("base_spans", pa.string()), ("spans", pa.string())])


def scan(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``<id>, n_assign, n_access, n_hex, base_spans, spans`` of every row; spans are ``kind:start:end``."""
    def run(batches):
        sink = Sink(_SCAN)
        for key, text in rows_of(batches):
            base = shapes(text)
            spans = base + named(text, threshold)
            counts = Counter(s.kind for s in base)
            if sink.add((key, counts["assign"], counts["access"], counts["hex"], _joined(base), _joined(spans)), 128 + 32 * len(spans)):
                yield sink.flush()
        yield sink.flush()

    rows = df.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
    out = rows.mapInArrow(run, "row_key bigint, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string")
    return out.withColumnRenamed("row_key", id_column)
