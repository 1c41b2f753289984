"""Streams of events: windowed counts with late data, last record by key, and idempotent reservations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def read_events(spark: SparkSession, folder: str, glob: str = "*.parquet", files: int = 1) -> DataFrame:
    """A stream over Parquet files of events, with ts as the event time."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", glob).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and values by type and tumbling window; rows later than `late` behind the latest are dropped by the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v")).select(F.col("window.start").alias("start"), "event_type", "n", "v")


def quiet_sessions(events: DataFrame, gap: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    """Sessions by user that close after a quiet interval."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def upsert_latest(batch: DataFrame, store: str, key: str, order: str) -> None:
    """For foreachBatch: the store's new version holds the last record by key of the store and the batch. A batch that
    comes twice changes nothing. Versions are folders; the highest complete one is current."""
    spark = batch.sparkSession
    version, old = current(spark, store)
    rows = batch if old is None else old.unionByName(batch)
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n").write.mode("overwrite").parquet(f"{store}/v{version + 1:08d}")


def current(spark: SparkSession, store: str) -> tuple[int, DataFrame | None]:
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    done = sorted(n for n in found if n[0] == "v" and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{store}/{n}/_SUCCESS")))
    return (int(done[-1][1:]), spark.read.parquet(f"{store}/{done[-1]}")) if done else (0, None)


def reserve(batch: DataFrame, ledger: str, cap: int) -> int:
    """For foreachBatch: reserve pages (reservation_id, page_id) that no reservation has, all or nothing under the cap."""
    spark = batch.sparkSession
    version, old = current(spark, ledger)
    fresh = batch.dropDuplicates(["page_id"]) if old is None else batch.dropDuplicates(["page_id"]).join(old.select("page_id"), "page_id", "left_anti")
    n, used = fresh.count(), 0 if old is None else old.count()
    if not n or used + n > cap:
        return 0
    rows = fresh.select("reservation_id", "page_id")
    (rows if old is None else old.unionByName(rows)).write.mode("overwrite").parquet(f"{ledger}/v{version + 1:08d}")
    return n
