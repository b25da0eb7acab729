"""Change logs made from the whole ``orders`` table: the customer is the key, the status the change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Landing
from ..operators.changes import current_rows, version_history
from ..operators.quality import version_faults
from ..operators.summarize import op_breakdown
from ..plans import change_bronze
from ..session import scratch_path, task_slots
from ..sinks.history import History
from ..streaming.landing import file_stream
from ..streaming.replay import ChangeState, replay_stream
from .base import Query, fresh_schema, read

KEYS = ["o_custkey"]
SEQUENCE = ["o_orderdate", "o_orderkey"]
# Groups above this size take the range route already on small tables.

_LOG = """
  SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
         CASE o_orderstatus WHEN 'F' THEN 'I' WHEN 'O' THEN 'U' ELSE 'D' END AS _op FROM orders"""

_EXPECTED_CURRENT = f"""
  SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
    SELECT * FROM ({_LOG})
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
  WHERE _op <> 'D'"""

_EXPECTED_HISTORY = f"""
  SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, o_orderdate AS valid_from, valid_to,
         valid_to IS NULL AS is_current
  FROM (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to
        FROM ({_LOG})) WHERE _op <> 'D'"""


def _op_of(status: str, insert: str, update: str) -> Column:
    column = F.col(status)
    return F.when(column == insert, "I").when(column == update, "U").otherwise("D")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice",
        _op_of("o_orderstatus", "F", "O").alias("_op"))


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", _op_of("l_returnflag", "A", "N").alias("_op"))


def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op_breakdown({"orders": order_log(spark, sf_dir), "lineitem": line_log(spark, sf_dir)})


def cdc_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(order_log(spark, sf_dir), KEYS, SEQUENCE)


def cdc_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_history(order_log(spark, sf_dir), KEYS, SEQUENCE)


def cdc_history_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in five shuffled batches with late changes and deletes, one of them twice, merged one by one."""
    log = order_log(spark, sf_dir)
    history = History(f"{fresh_schema(spark)}.order_history", KEYS, SEQUENCE, buckets=8)
    for batch in (3, 0, 4, 1, 0, 2):
        history.merge(log.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(5)) == batch))
    return history.versions(spark)


def cdc_history_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of a log with three keys, so each key holds a third of all changes."""
    log = read(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderdate", "o_orderkey", F.lit("U").alias("_op"))
    return version_history(log, ["o_orderstatus"], SEQUENCE)


def cdc_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in four batches, newest first, one of them twice, with a compaction between."""
    log = order_log(spark, sf_dir)
    state = ChangeState(spark, scratch_path(spark, "state"), log.schema, KEYS, SEQUENCE)
    year = F.year("o_orderdate")
    spans = [year >= 2000, year.isin(1998, 1999), year.isin(1996, 1997), year <= 1995]
    for batch, span in enumerate(spans):
        state.apply(log.where(span), batch)
        if batch == 1:
            state.apply(log.where(span), batch)
            state.compact()
    return state.current()


def cdc_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed log files, a third of them per micro-batch, folded into the state by a stream."""
    log = order_log(spark, sf_dir)
    landing = scratch_path(spark, "log")
    slots = task_slots(spark)
    log.repartition(slots).write.parquet(landing)
    state = ChangeState(spark, scratch_path(spark, "state"), log.schema, KEYS, SEQUENCE)
    stream = file_stream(spark, landing, "parquet", log.schema, {"maxFilesPerTrigger": str(max(1, slots // 3))})
    replay_stream(stream, state, scratch_path(spark, "checkpoint"), compact_every=2).awaitTermination()
    return state.current()


def change_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two tables in dated folders -> bronze tables -> rows per kind of change."""
    root = scratch_path(spark, "changes")
    for name, log in {"orders": order_log(spark, sf_dir), "lines": line_log(spark, sf_dir)}.items():
        log.withColumnRenamed("_op", "Op").write.parquet(f"{root}/{name}/2024/01/02")
    config = Landing(root, "shop", fresh_schema(spark), state=scratch_path(spark, "checkpoint"))
    outcomes = change_bronze.run(spark, config)
    for error in outcomes.values():
        if error is not None:
            raise error
    return change_bronze.summary(spark, config, outcomes)


def dq_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults in a sound history, and in one where every closed version is left open."""
    sound = cdc_history(spark, sf_dir)
    broken = sound.withColumns({"valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)})
    label = F.lit("sound").alias("history"), F.lit("broken").alias("history")
    return (version_faults(sound, KEYS).select(label[0], "*")
            .unionAll(version_faults(broken, KEYS).select(label[1], "*")))


QUERIES = {
    "change_counts": Query(change_counts, f"""
        WITH counted AS (
          SELECT 'orders' AS table_name, _op AS op, count(*) AS op_rows FROM ({_LOG}) GROUP BY ALL
          UNION ALL
          SELECT 'lineitem', CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'U' ELSE 'D' END, count(*)
          FROM lineitem GROUP BY ALL)
        SELECT *, CAST(sum(op_rows) OVER (PARTITION BY table_name) AS BIGINT) AS total_rows FROM counted"""),
    "cdc_current": Query(cdc_current, _EXPECTED_CURRENT),
    "cdc_history": Query(cdc_history, _EXPECTED_HISTORY),
    "cdc_history_merge": Query(cdc_history_merge, _EXPECTED_HISTORY),
    "cdc_history_by_status": Query(cdc_history_by_status, """
        SELECT o_orderstatus, o_orderdate, o_orderkey, o_orderdate AS valid_from, valid_to,
               valid_to IS NULL AS is_current
        FROM (SELECT *, lead(o_orderdate) OVER (PARTITION BY o_orderstatus
                                                ORDER BY o_orderdate, o_orderkey) AS valid_to FROM orders)"""),
    "cdc_state_merge": Query(cdc_state_merge, _EXPECTED_CURRENT),
    "cdc_stream_replay": Query(cdc_stream_replay, _EXPECTED_CURRENT),
    "change_landing": Query(change_landing, f"""
        WITH counted AS (
          SELECT 'orders' AS table_name, _op AS op, count(*) AS op_rows FROM ({_LOG}) GROUP BY ALL
          UNION ALL
          SELECT 'lines', CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'N' THEN 'U' ELSE 'D' END, count(*)
          FROM lineitem GROUP BY ALL)
        SELECT *, CAST(sum(op_rows) OVER (PARTITION BY table_name) AS BIGINT) AS total_rows FROM counted"""),
    "dq_versions": Query(dq_versions, f"""
        WITH sound AS ({_EXPECTED_HISTORY}),
        labelled AS (
          SELECT 'sound' AS history, o_custkey, valid_from, valid_to, is_current FROM sound
          UNION ALL SELECT 'broken', o_custkey, valid_from, NULL, true FROM sound),
        timed AS (SELECT *, lead(valid_from) OVER (PARTITION BY history, o_custkey
                                                   ORDER BY valid_from, valid_to NULLS LAST) AS next_from
                  FROM labelled),
        crossed AS (SELECT history, count(*) FILTER (WHERE next_from IS NOT NULL
                            AND (valid_to IS NULL OR valid_to > next_from)) AS overlapping_versions
                     FROM timed GROUP BY history),
        several AS (SELECT history, count(*) FILTER (WHERE n > 1) AS keys_with_several_current
                    FROM (SELECT history, o_custkey, count(*) FILTER (WHERE is_current) AS n
                          FROM labelled GROUP BY ALL) GROUP BY history)
        SELECT history, keys_with_several_current, overlapping_versions
        FROM several JOIN crossed USING (history)"""),
}
