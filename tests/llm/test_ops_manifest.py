"""The Merkle manifest, held against a plain walk over lists."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from siltworks.llm import merkle

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def _digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    doc_id, text, lang, source, n_chars = row
    return _digest(*map(field, (doc_id, source, lang, n_chars, text)))


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_digest(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def _siblings(levels, at):
    steps = []
    for level in levels[:-1]:
        start = at // 3 * 3
        steps.append(("".join(level[start:at]), "".join(level[at + 1:start + 3])))
        at //= 3
    return steps


def _plain(rows):
    """``doc_id, leaf, subroot, root, steps`` of all rows, in any order."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(((r[0] is not None, r[0] or 0, bytes.fromhex(_leaf(r)), r[0]) for r in groups[s])) for s in order}
    trees = {s: _levels([x[2].hex() for x in leaves[s]]) for s in order}
    total = _levels([trees[s][-1][0] for s in order]) if order else []
    return [(x[3], x[2].hex(), trees[s][-1][0], total[-1][0], _siblings(trees[s], k) + _siblings(total, n))
            for n, s in enumerate(order) for k, x in enumerate(leaves[s])]


def _key(row):
    return repr(row)


def _manifest(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.proof]) for r in merkle.manifest(df).collect()]


@pytest.mark.parametrize("height", [1, 2, 4])
def test_against_lists(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    sizes = {"hot": 61, None: 9, "": 1, "é": 3, "z": 4, "ab": 28}
    rows, number = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            number += 1
            rows.append((number * 7 % 1000, f"text {number}\nline", "en", source, number))
    df = spark.createDataFrame(rows, DOC).repartition(5)
    assert sorted(_manifest(df), key=_key) == sorted(_plain(rows), key=_key)


def test_odd_rows(spark):
    rows = [(None, "a", "en", None, 1), (None, "b", None, None, None), (1, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "x", "en", "s", 1),
            (2, "x", "en", "s", 1), (3, "é\n" * 300_000, "fr", "s", 2), (-4, "y", "", "", 5)]
    df = spark.createDataFrame(rows, DOC)
    clash = df
    for name in ("grp", "id", "leaf", "place", "node", "above", "load", "more", "proof", "_slice", "_placed", "root"):
        clash = clash.withColumn(name, F.lit("mine"))
    expected = sorted(_plain(rows), key=_key)
    assert sorted(_manifest(df), key=_key) == expected
    assert sorted(_manifest(clash), key=_key) == expected


def test_small_tables(spark):
    one = [(5, "only", "en", "s", 4)]
    found = _manifest(spark.createDataFrame(one, DOC))
    assert found == _plain(one) and found[0][1] == found[0][2] == found[0][3] and found[0][4] == []
    empty = spark.createDataFrame([], DOC)
    assert merkle.manifest(empty).collect() == []
    assert merkle.manifest(empty).columns == ["doc_id", "leaf", "subroot", "root", "proof"]


def test_folds_show_changed_rows(spark):
    rows = [(k, f"t{k}\n" if k % 3 else f"t{k}", "en", f"s{k % 4}", k) for k in range(40)]
    df = spark.createDataFrame(rows, DOC)
    fields = {name: F.col(name) for name in merkle.FIELDS} | {"text": F.translate("text", "\n", "")}
    found = merkle.manifest(df, carry={"altered": merkle.leaf_of(fields)})
    seen = found.select("doc_id", (merkle.fold(F.col("altered"), F.col("proof")) == F.col("root")).alias("same"),
                        (merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("sound")).collect()
    assert all(r.sound for r in seen)
    assert {r.doc_id for r in seen if not r.same} == {k for k in range(40) if k % 3}


def test_proofs_come_without_joins(spark):
    df = spark.createDataFrame([(k, "t", "en", "s", k) for k in range(100)], DOC)
    plan = merkle.manifest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
