"""History merged batch by batch against the history of the whole log."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from siltworks.operators.changes import version_history
from siltworks.sinks.history import PART, History

LOG = "k int, at int, n int, v string, _op string"


def _rows(df):
    return sorted(map(repr, df.select("k", "at", "n", "v", "valid_from", "valid_to", "is_current").collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order(spark, schema, seed):
    rng = random.Random(seed)
    log = [(None if rng.random() < 0.1 else rng.randint(0, 6), rng.randint(0, 40), n, f"v{n}", rng.choice("IUUUD")) for n in range(120)]
    history = History(f"{schema}.h", ["k"], ["at", "n"], buckets=4)
    rng.shuffle(log)
    seen = []
    for batch in (log[:30], log[30:31], log[31:90], log[:30], log[90:]):
        history.merge(spark.createDataFrame(batch, LOG))
        seen = list(dict.fromkeys(seen + batch))
        assert _rows(history.versions(spark)) == _rows(version_history(spark.createDataFrame(seen, LOG), ["k"], ["at", "n"]))


def test_a_late_change_splits_a_version_and_a_delete_closes_one(spark, schema):
    history = History(f"{schema}.h", ["k"], ["at", "n"], buckets=2)
    for change in [(1, 10, 0, "a", "I"), (1, 30, 2, "c", "U"), (1, 20, 1, "b", "U"), (1, 40, 3, None, "D"), (1, 35, 4, "d", "U"), (1, 50, 5, "e", "I")]:
        history.merge(spark.createDataFrame([change], LOG))
    found = sorted((r.valid_from, r.valid_to, r.v, r.is_current) for r in history.versions(spark).collect())
    assert found == [(10, 20, "a", False), (20, 30, "b", False), (30, 35, "c", False), (35, 40, "d", False), (50, None, "e", True)]


def test_untouched_keys_stay_where_they_are(spark, schema):
    history = History(f"{schema}.h", ["k"], ["at", "n"], buckets=16)
    history.merge(spark.createDataFrame([(k, 1, 0, "x", "I") for k in range(60)], LOG))
    names = lambda: {r[0]: r[1] for r in spark.table(history.table).select(PART, F.input_file_name()).distinct().collect()}
    before = names()
    history.merge(spark.createDataFrame([(7, 2, 0, "y", "U")], LOG))
    after = names()
    assert len([part for part in after if after[part] != before[part]]) == 1
    history.merge(spark.createDataFrame([], LOG))
    assert names() == after
    history.merge(spark.createDataFrame([(8, 2, 0, "y", "U", 1.5)], LOG + ", extra double"))
    assert history.versions(spark).where("extra = 1.5").count() == 1 and history.versions(spark).count() == 62


def test_no_op_column(spark, schema):
    with pytest.raises(ValueError, match="_op"):
        History(f"{schema}.h", ["k"], ["at"]).merge(spark.range(1).select(F.col("id").alias("k"), F.lit(1).alias("at")))
