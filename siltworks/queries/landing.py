"""Files written from the given tables, then found, read and streamed into bronze tables."""

from __future__ import annotations

import io
import zipfile
from functools import reduce
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DomainConfig, Landing, Reading
from ..functions import with_lineage
from ..operators.quality import missing_files
from ..operators.rescue import rescue_types
from ..plans import batch_files, change_bronze, shared_landing
from ..plans.datasets import DatasetMap
from ..session import scratch_path
from ..sources.archives import archive_lines, archive_members, extract_members, parse_csv_lines
from ..sources.discovery import tables_by_folder, tables_by_stem, tables_by_suffix
from ..sources.files import arrow_location, list_files, read_files, read_partitions
from ..sources.register import FileRegister
from ..streaming.landing import append_stream, distinct_stream, file_stream
from .base import Query, fresh_schema, nullable, read

# The given tables.
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _raise_first(outcomes: dict[str, Exception | None]) -> None:
    for error in outcomes.values():
        if error is not None:
            raise error


def shared_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder of given tables as landing root: every name found, of a file or a folder of part files, becomes a bronze table."""
    schema = fresh_schema(spark)
    _raise_first(shared_landing.run(spark, sf_dir, schema, scratch_path(spark, "checkpoint")))
    counts = [spark.table(f"{schema}.{t}").groupBy("_source_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("_source_file").isNull()).alias("unsourced"))
        for t in tables_by_suffix(spark, schema)]
    return reduce(DataFrame.unionAll, counts).withColumnRenamed("_source_name", "source_name")


def stream_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders land in two waves, the second with one more column; both go to one bronze table."""
    orders = read(spark, sf_dir, "orders").withColumn("Op", F.lit("I"))
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    root = scratch_path(spark, "waves")
    config = Landing(root, "shop", fresh_schema(spark), state=scratch_path(spark, "checkpoint"))
    orders.where(early).drop("o_orderpriority").write.parquet(f"{root}/orders/1997/12/31")
    _raise_first(change_bronze.run(spark, config))
    orders.where(~early).write.parquet(f"{root}/orders/2001/12/31")
    _raise_first(change_bronze.run(spark, config))
    return spark.table(config.layout("orders").bronze).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority", "_op", "_source_table")


def stream_schema_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose later half, with one more column, lands while the stream of the first half is running."""
    orders = read(spark, sf_dir, "orders").withColumn("Op", F.lit("I"))
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    root = scratch_path(spark, "waves")
    config = Landing(root, "shop", fresh_schema(spark), state=scratch_path(spark, "checkpoint"))
    orders.where(early).drop("o_orderpriority").write.parquet(f"{root}/orders/1997/12/31")
    query = change_bronze.start_table(spark, config, "orders", every="1 second")
    try:
        query.processAllAvailable()
        orders.where(~early).write.parquet(f"{root}/orders/2001/12/31")
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.table(config.layout("orders").bronze).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "_op", "_source_table")


def files_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of files that landed after the last run, found from the register without reading the table."""
    orders, root = read(spark, sf_dir, "orders").withColumn("Op", F.lit("I")), scratch_path(spark, "waves")
    config = Landing(root, "shop", fresh_schema(spark), state=scratch_path(spark, "checkpoint"))
    for number, status in enumerate(("F", "O", "P")):
        orders.where(F.col("o_orderstatus") == status).write.parquet(f"{root}/orders/{number}")
        if status != "P":
            _raise_first(change_bronze.run(spark, config))
    register = FileRegister.beside(spark, config.layout("orders").bronze)
    landed = list_files(spark, f"{root}/orders", "*.parquet")
    pending = landed.join(missing_files(landed, register.taken(), file_column="file_path"), "file_path", "left_semi")
    waiting = [r.path for r in pending.select("path").toLocalIterator()]  # the reader needs their names
    return read_files(spark, waiting, "parquet", orders.schema).drop("Op")


def stream_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders land in two waves, the second with customer keys as text that is not always a number."""
    orders = read(spark, sf_dir, "orders").withColumn("Op", F.lit("I"))
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    odd = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C"), "o_custkey")).otherwise(
        F.col("o_custkey").cast("string"))
    root = scratch_path(spark, "waves")
    config = Landing(root, "shop", fresh_schema(spark), state=scratch_path(spark, "checkpoint"),
                     reading=Reading(rescue=True))
    orders.where(early).write.parquet(f"{root}/orders/1997/12/31")
    _raise_first(change_bronze.run(spark, config))
    orders.where(~early).withColumn("o_custkey", odd).write.parquet(f"{root}/orders/2001/12/31")
    _raise_first(change_bronze.run(spark, config))
    return spark.table(config.layout("orders").bronze).select(
        "o_orderkey", nullable("o_custkey"), "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        F.col("_rescued_data").alias("rescued"))


def shared_root_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers land as CSV in one root in two waves, the second of orders with one more
    column that comes first; types are found from the new files of each wave."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    root, schema, base = (scratch_path(spark, label) for label in ("shared", "unused", "checkpoint"))
    schema = fresh_schema(spark)
    waves = [{"orders": orders.where(early).drop("o_orderpriority"), "customer": customers.where("c_custkey % 2 = 0")},
             {"orders": orders.where(~early).select("o_orderpriority", *[c for c in orders.columns if c != "o_orderpriority"]),
              "customer": customers.where("c_custkey % 2 = 1")}]
    for number, wave in enumerate(waves):
        for name, df in wave.items():
            _write_one(df, f"{root}/{number}/{name}.csv")
        _raise_first(shared_landing.run(spark, root, schema, base, Reading("csv")))
    landed, people = spark.table(f"{schema}.orders_bronze"), spark.table(f"{schema}.customer_bronze")
    return landed.join(people, landed["o_custkey"] == people["c_custkey"]).select(
        *[F.col(c).cast(t).alias(c) for c, t in (*orders.dtypes, *customers.dtypes)], landed["_rescued_data"].alias("rescued"))


def _write_one(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """Write rows as files, each of which has the name that the landing knows the table by."""
    spark, temporary = df.sparkSession, f"{path}.parts"
    df.write.format(file_format).options(**({"header": "true"} if file_format == "csv" else {})).save(temporary)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(temporary)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for number, status in enumerate(files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{temporary}/part-*"))):
        parent = jvm.org.apache.hadoop.fs.Path(f"{path}-{number}")
        files.mkdirs(parent)
        files.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(parent, path.rsplit("/", 1)[-1]))
    files.delete(folder, True)


def change_landing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders land as JSON change files in two waves; in the second the priority is new and keys of
    status P are no numbers."""
    orders = read(spark, sf_dir, "orders").withColumn("Op", F.lit("I"))
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    odd = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C"), "o_custkey")).otherwise(F.col("o_custkey").cast("string"))
    root = scratch_path(spark, "waves")
    config = Landing(root, "shop", fresh_schema(spark), state=scratch_path(spark, "checkpoint"), reading=Reading("json"))
    orders.where(early).drop("o_orderpriority").write.json(f"{root}/orders/1997/12/31")
    _raise_first(change_bronze.run(spark, config))
    orders.where(~early).withColumn("o_custkey", odd).write.json(f"{root}/orders/2001/12/31")
    _raise_first(change_bronze.run(spark, config))
    return spark.table(config.layout("orders").bronze).select(
        "o_orderkey", nullable("o_custkey"), "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "o_orderpriority", "_op",
        F.col("_rescued_data").alias("rescued"))


def csv_surplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders land as CSV in which records have fields too many, fields too few, quoted line breaks and
    escaped quotes; no field of any record is lost."""
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 5
    plain = F.concat_ws(",", key, F.col("o_custkey").cast("string"))
    line = (F.when(kind == 1, F.concat_ws(",", plain, "o_orderstatus", F.concat(F.lit("more-"), key), F.lit("")))
            .when(kind == 2, plain)
            .when(kind == 3, F.concat(plain, F.lit(',"first '), key, F.lit('\nsecond, line"')))
            .when(kind == 4, F.concat(plain, F.lit(',"said \\"'), key, F.lit('\\" twice"')))
            .otherwise(F.concat_ws(",", plain, "o_orderpriority")))

    def headed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["id,customer,note"]})
        yield from batches

    root, schema, checkpoint = scratch_path(spark, "waves"), fresh_schema(spark), scratch_path(spark, "checkpoint")
    lines = read(spark, sf_dir, "orders").select(line.alias("value"), kind.alias("kind"))
    for number, wave in enumerate(("kind < 3", "kind >= 3")):  # files of the first can be split, of the second not
        _write_one(lines.where(wave).select("value").mapInPandas(headed, "value string"), f"{root}/{number}/orders.csv", "text")
        _raise_first(shared_landing.run(spark, root, schema, checkpoint, Reading("csv")))
    return spark.table(f"{schema}.orders_bronze").select(
        F.col("id").cast("bigint").alias("id"), F.col("customer").cast("bigint").alias("customer"), "note",
        F.col("_rescued_data").alias("rescued"))


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive several times within a run and in later runs; a third of all rows repeats one event."""
    landing, table = scratch_path(spark, "events"), f"{fresh_schema(spark)}.events_silver"
    events, checkpoint = read(spark, sf_dir, "events"), scratch_path(spark, "checkpoint")
    half = events.where("event_id % 2 = 0")
    first = events.agg(F.min("event_id")).first()[0]
    copies = max(1, events.count() // 2)
    hot = events.where(F.col("event_id") == first).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    for number, wave in enumerate((half.unionAll(half.where("event_id % 3 = 0")), events.unionAll(hot))):
        wave.write.parquet(f"{landing}/{number}")
        stream = distinct_stream(file_stream(spark, landing, "parquet", events.schema), ["event_id"])
        append_stream(stream, table, checkpoint).awaitTermination()
    return spark.table(table)


def stream_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose second half lands later with a modification time of a month before the first."""
    landing, table = scratch_path(spark, "events"), f"{fresh_schema(spark)}.events_bronze"
    events, checkpoint = read(spark, sf_dir, "events"), scratch_path(spark, "checkpoint")
    for number, half in enumerate((events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1"))):
        half.write.parquet(f"{landing}/{number}")
        if number:
            _age(spark, f"{landing}/{number}", 30)
        append_stream(file_stream(spark, landing, "parquet", events.schema), table, checkpoint).awaitTermination()
    return spark.table(table)


def _age(spark: SparkSession, folder: str, days: int) -> None:
    """Set the files' modification times back."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        files.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


def rescued_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cast to whole prices and to dates: what a cast would cut off is kept as it came."""
    orders = read(spark, sf_dir, "orders").withColumns({
        "o_totalprice": F.when(F.col("o_orderkey") % 3 == 0, F.floor("o_totalprice").cast("double")).otherwise(F.col("o_totalprice")),
        "o_orderdate": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR"))
        .otherwise(F.col("o_orderdate"))})
    target = T.StructType([T.StructField(f.name, {"o_totalprice": T.LongType(), "o_orderdate": T.DateType()}.get(f.name, f.dataType))
                           for f in orders.schema.fields])
    kept = rescue_types(orders, target)
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", nullable("o_totalprice"),
                       F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderpriority",
                       F.get_json_object("_rescued_data", "$.o_totalprice").cast("double").alias("rescued_price"),
                       F.get_json_object("_rescued_data", "$.o_orderdate").alias("rescued_date"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed twice over one checkpoint: the second run finds nothing new."""
    landing, table = scratch_path(spark, "events"), f"{fresh_schema(spark)}.events_bronze"
    events = read(spark, sf_dir, "events")
    events.write.parquet(landing)
    checkpoint = scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream = with_lineage(file_stream(spark, landing, "parquet", events.schema),
                              ingested_at="_ingest_ts", source_file="_source_file",
                              tags={"_source_name": "events"})
        append_stream(stream, table, checkpoint).awaitTermination()
    return spark.table(table).drop("_ingest_ts", "_source_file")


def batch_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed CSV files found by wildcard, types inferred; the second load skips seen files."""
    root, schema = scratch_path(spark, "domain"), fresh_schema(spark)
    read(spark, sf_dir, "customer").write.option("header", "true").option(
        "compression", "gzip").csv(f"{root}/daily/customer")
    files = {"filenames": [{"name": "customer/*.csv.gz", "table": "customer_bronze"}]}
    for _ in range(2):
        batch_files.run(spark, DomainConfig.from_dict(root, schema, files, skip_seen=True))
    return (spark.table(f"{schema}.customer_bronze").drop("_ingest_timestamp", "_source_file")
            .withColumn("c_custkey", F.col("c_custkey").cast("bigint")))


def batch_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One domain with CSV, JSON, Parquet, ORC and text files; rows and key totals per table."""
    root, schema = scratch_path(spark, "domain"), fresh_schema(spark)
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey",
            "lineitem": "l_orderkey", "documents": "doc_id"}
    tables = {t: read(spark, sf_dir, t) for t in keys}
    tables["customer"].write.option("header", "true").csv(f"{root}/customer")
    tables["orders"].write.json(f"{root}/orders")
    tables["part"].write.parquet(f"{root}/part")
    tables["lineitem"].select(*[F.col(c).cast(_storable(t)) for c, t in tables["lineitem"].dtypes]
                              ).write.orc(f"{root}/lineitem")
    tables["documents"].select(F.col("doc_id").cast("string")).write.text(f"{root}/documents")
    names = {"customer": "customer/*.csv", "orders": "orders/*.json", "part": "part/*.parquet",
             "lineitem": "*.orc", "documents": "documents/*.txt"}
    files = {"filenames": [{"name": n, "table": f"{t}_bronze"} for t, n in names.items()]
             + [{"name": "nothing.csv", "table": "nothing_bronze"}]}
    batch_files.run(spark, DomainConfig.from_dict(root, schema, files, mode="overwrite"))
    parts = [spark.table(f"{schema}.{t}_bronze").agg(
        F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("value" if t == "documents" else key).cast("bigint")).alias("key_total"))
        for t, key in keys.items()]
    return reduce(DataFrame.unionAll, parts)


def _loaded(spark: SparkSession, written: DataFrame, file_format: str, pattern: str, options: dict[str, str] | None = None) -> DataFrame:
    """All rows of a table that was written in a format and loaded as a domain's file."""
    root, schema = scratch_path(spark, "domain"), fresh_schema(spark)
    written.write.format(file_format).options(**(options or {})).save(f"{root}/day/table")
    files = {"filenames": [{"name": pattern, "table": "loaded", "options": options or {}}]}
    batch_files.run(spark, DomainConfig.from_dict(root, schema, files))
    return spark.table(f"{schema}.loaded").drop("_ingest_timestamp", "_source_file")


def batch_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of documents, blank and very long lines among them, landed as text files: every line."""
    texts = read(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("value"))
    return _loaded(spark, texts, "text", "table/*.txt", {"lineSep": "\n"})


def batch_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as JSON: every column of every row."""
    orders = read(spark, sf_dir, "orders")
    rows = _loaded(spark, orders, "json", "table/*.json")
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in orders.dtypes])


def batch_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items landed as ORC: every column of every row."""
    lines = read(spark, sf_dir, "lineitem")
    rows = _loaded(spark, lines.select(*[F.col(c).cast(_storable(t)).alias(c) for c, t in lines.dtypes]), "orc", "*.orc")
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in lines.dtypes])


def batch_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as Parquet: every column of every row, whole texts."""
    return _loaded(spark, read(spark, sf_dir, "documents"), "parquet", "table/*.parquet")


def _storable(type_name: str) -> str:
    """Timestamps keep a zone in ORC files that older readers open."""
    return "timestamp" if type_name == "timestamp_ntz" else type_name


def partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by status; only the folders of two statuses are read."""
    root = scratch_path(spark, "by_status")
    orders = read(spark, sf_dir, "orders")
    orders.write.partitionBy("o_orderstatus").parquet(root)
    return read_partitions(spark, root, "parquet", orders.schema, o_orderstatus=["F", "O"])


def folder_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables found as folders, each read whole."""
    root = scratch_path(spark, "folders")
    for table in ("orders", "customer", "part"):
        read(spark, sf_dir, table).write.parquet(f"{root}/{table}")
    return reduce(DataFrame.unionAll, [
        read_files(spark, f"{root}/{t}", "parquet").agg(F.lit(t).alias("table_name"),
                                                        F.count(F.lit(1)).alias("row_count"))
        for t in tables_by_folder(spark, root)])


def stem_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables found by the name of a file or of a folder of part files, each read whole."""
    return reduce(DataFrame.unionAll, [
        read(spark, sf_dir, stem).agg(F.lit(stem).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for stem in tables_by_stem(spark, sf_dir, "parquet")])


def _zip_customers(spark: SparkSession, sf_dir: str) -> str:
    """Customers as zip archives of CSV files, two archives per batch of rows; all members have one name."""
    folder = scratch_path(spark, "archives")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            target, base = arrow_location(folder)
            target.create_dir(base, recursive=True)
            for half in range(2):
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("customer.csv", batch[half::2].to_csv(index=False))
                with target.open_output_stream(f"{base}/{part}-{number}-{half}.zip") as sink:
                    sink.write(packed.getvalue())
            yield pd.DataFrame({"rows": [len(batch)]})

    read(spark, sf_dir, "customer").mapInPandas(pack, "rows bigint").agg(F.sum("rows")).first()
    return folder


def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the CSV members of zip archives, parsed from their lines."""
    lines = archive_lines(spark, _zip_customers(spark, sf_dir))
    return parse_csv_lines(lines, read(spark, sf_dir, "customer").schema).drop("archive", "entry")


def archive_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members hold every row once: a line per customer plus a header per member."""
    members = archive_members(spark, _zip_customers(spark, sf_dir))
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 2
    return members.agg(F.sum(lines).alias("row_count"))


def archive_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members unpacked to a landing folder and read from there, also below folders of archives."""
    landing = scratch_path(spark, "unpacked")
    extract_members(spark, _zip_customers(spark, sf_dir), landing).agg(F.sum("bytes")).first()
    return read_files(spark, landing, "csv", read(spark, sf_dir, "customer").schema, {"recursiveFileLookup": "true"})


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed rows whose files the bronze table has not taken in yet."""
    root = scratch_path(spark, "landed")
    orders = read(spark, sf_dir, "orders")
    orders.write.partitionBy("o_orderstatus").parquet(root)
    bronze = with_lineage(read_files(spark, root, "parquet", orders.schema), source_file="_source_file")
    taken_in = bronze.where("o_orderstatus <> 'P'")
    missing = missing_files(list_files(spark, root, "*.parquet"), taken_in)
    waiting = bronze.join(missing, bronze["_source_file"] == missing["file_path"], "left_semi")
    return waiting.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows_missing"))


def declared_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streamed and a batch dataset declared as functions, written in order."""
    schema, landing = fresh_schema(spark), scratch_path(spark, "landing")
    orders = read(spark, sf_dir, "orders")
    orders.write.parquet(landing)
    datasets = DatasetMap()

    @datasets.table(comment="Orders as landed.", properties={"quality": "bronze"})
    def orders_bronze(session: SparkSession) -> DataFrame:
        return file_stream(session, landing, "parquet", orders.schema)

    @datasets.table("orders_by_status", comment="Orders per status.")
    def by_status(session: SparkSession) -> DataFrame:
        return session.table(f"{schema}.orders_bronze").groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("order_count"), F.max("o_totalprice").alias("highest"))

    datasets.write_all(spark, schema, scratch_path(spark, "checkpoint"))
    return spark.table(f"{schema}.orders_by_status")


def _counts(tables: list[str], name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS {name}, count(*) AS row_count FROM {t}" for t in tables)


_CUSTOMERS = "SELECT * FROM customer"

QUERIES = {
    "shared_root": Query(shared_root, f"""
        SELECT *, CAST(0 AS BIGINT) AS unsourced FROM ({_counts(TABLES, "source_name")})"""),
    "stream_evolve": Query(stream_evolve, """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
               'I' AS _op, 'shop.orders' AS _source_table FROM orders"""),
    "stream_schema_race": Query(stream_schema_race, """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
               'I' AS _op, 'shop.orders' AS _source_table FROM orders"""),
    "files_pending": Query(files_pending, "SELECT * FROM orders WHERE o_orderstatus = 'P'"),
    "stream_rescue": Query(stream_rescue, """
        SELECT o_orderkey, CAST(CASE WHEN NOT odd THEN o_custkey END AS DOUBLE) AS o_custkey, o_orderstatus,
               o_totalprice, o_orderdate, o_orderpriority, CASE WHEN odd THEN '{"o_custkey":"C' || o_custkey || '"}' END AS rescued
        FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'P' AS odd FROM orders)"""),
    "shared_root_csv": Query(shared_root_csv, """
        SELECT o.* REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority),
               c.*, CAST(NULL AS VARCHAR) AS rescued FROM orders o JOIN customer c ON o_custkey = c_custkey"""),
    "change_landing_json": Query(change_landing_json, """
        SELECT o_orderkey, CAST(CASE WHEN NOT odd THEN o_custkey END AS DOUBLE) AS o_custkey, o_orderstatus, o_totalprice,
               o_orderdate, CASE WHEN late THEN o_orderpriority END AS o_orderpriority, 'I' AS _op,
               CASE WHEN odd THEN '{"o_custkey":"C' || o_custkey || '"}' END AS rescued
        FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01' AS late,
                     o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'P' AS odd FROM orders)"""),
    "csv_surplus": Query(csv_surplus, """
        SELECT o_orderkey AS id, o_custkey AS customer,
               CASE o_orderkey % 5 WHEN 1 THEN o_orderstatus WHEN 3 THEN 'first ' || o_orderkey || chr(10) || 'second, line'
                    WHEN 4 THEN 'said "' || o_orderkey || '" twice' WHEN 0 THEN o_orderpriority END AS note,
               CASE o_orderkey % 5 WHEN 1 THEN '{"_record":"' || o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',more-' || o_orderkey || ',"}'
                    WHEN 2 THEN '{"_record":"' || o_orderkey || ',' || o_custkey || '"}' END AS rescued
        FROM orders"""),
    "stream_distinct": Query(stream_distinct, "SELECT * FROM events"),
    "stream_late_files": Query(stream_late_files, "SELECT * FROM events"),
    "rescued_decimals": Query(rescued_decimals, """
        SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN price = floor(price) THEN price END AS o_totalprice,
               CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate, o_orderpriority,
               CASE WHEN price <> floor(price) THEN price END AS rescued_price,
               CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') END AS rescued_date
        FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS price FROM orders)"""),
    "stream_events": Query(stream_events, "SELECT *, 'events' AS _source_name FROM events"),
    "batch_customers": Query(batch_customers, _CUSTOMERS),
    "batch_formats": Query(batch_formats, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(sum({k}) AS BIGINT) AS key_total FROM {t}"
        for t, k in [("customer", "c_custkey"), ("orders", "o_orderkey"), ("part", "p_partkey"),
                     ("lineitem", "l_orderkey"), ("documents", "doc_id")])),
    "batch_text": Query(batch_text, """
        SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS value FROM documents"""),
    "batch_json": Query(batch_json, "SELECT * FROM orders"),
    "batch_orc": Query(batch_orc, "SELECT * FROM lineitem"),
    "batch_parquet": Query(batch_parquet, "SELECT * FROM documents"),
    "partition_pruned": Query(partition_pruned, "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')"),
    "folder_discovery": Query(folder_discovery, _counts(["orders", "customer", "part"], "table_name")),
    "stem_discovery": Query(stem_discovery, _counts(TABLES, "table_name")),
    "archive_rows": Query(archive_rows, _CUSTOMERS),
    "archive_sizes": Query(archive_sizes, "SELECT count(*) AS row_count FROM customer"),
    "archive_extract": Query(archive_extract, _CUSTOMERS),
    "dq_completeness": Query(dq_completeness, """
        SELECT o_orderstatus, count(*) AS rows_missing FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL"""),
    "declared_datasets": Query(declared_datasets, """
        SELECT o_orderstatus, count(*) AS order_count, max(o_totalprice) AS highest FROM orders GROUP BY ALL"""),
}
