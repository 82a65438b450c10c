"""Feeds that arrive as files: continuous ingest, windowed measures, early warnings."""

from collections.abc import Callable, Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from larder.functions import changes, exact
from larder.operators import ingest
from larder.sources import feeds
from larder.sources.warehouse import Star

WEEK, MONDAY = "7 days", "4 days"  # the epoch was a Thursday


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None,
                fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def read_feed_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The lines of arriving CSV files; feeds.picked() reads those of a micro-batch by each file's header."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return feeds.lines(reader, path)


def ingest_files(spark: SparkSession, star: Star, stream: DataFrame,
                 to_feed: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 key: str | None = None) -> None:
    """Append each micro-batch of arrived files to the increments, until none is left.

    The checkpoint remembers the files, so a restarted run reads no file twice, and a repeated
    micro-batch overwrites its own folder. Rows of any age are accepted. Each batch writes how many
    rows there are after it, so the next reads one row instead of counting all before it.
    """
    stored, last_record, last_fact = ingest.last_ids(star)

    def write(batch: DataFrame, batch_id: int) -> None:
        before, known = _rows_after(spark, path, batch_id - 1), star
        if batch.isEmpty():
            _note_rows(spark, path, batch_id, before)
            return
        if before:
            # the calendar of earlier batches counts, so that undated rows move on a week each time
            dates = spark.read.parquet(f"{path}/date").where(F.col("batch_id") < batch_id)
            known = replace(star, date=star.date.unionByName(
                dates.drop("batch_id").dropDuplicates(["date_id"])))
        result = ingest.append(spark, known, to_feed(batch), path, batch_id, key,
                               (stored + before, last_record + before, last_fact + before)).first()
        _note_rows(spark, path, batch_id, before + result["records_added"])

    query = stream.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _note_rows(spark: SparkSession, path: str, batch_id: int, rows: int) -> None:
    spark.createDataFrame([(rows,)], "rows BIGINT").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/rows_after/batch_id={batch_id}")


def _rows_after(spark: SparkSession, path: str, batch_id: int) -> int:
    """Rows appended up to a batch; none before the first."""
    if batch_id < 0:
        return 0
    return spark.read.parquet(f"{path}/rows_after/batch_id={batch_id}").first()["rows"]


def window_measures(feed: DataFrame, star: Star, key: str | None = None, window: str = WEEK,
                    start: str | None = MONDAY, delay: str | None = "1 day") -> DataFrame:
    """Measures by tumbling window of the row's date, for a batch or a stream.

    On a stream, rows later than `delay` are dropped and closed windows can come out once
    (run_windows). Without a delay none is dropped, and a window comes out again whenever its totals
    change (run_late_windows); its state is one row for each window there ever was. Tasks total their
    rows before the shuffle, so a busy window is one row per task.
    """
    rows = ingest.normalize(feed, key).withColumn("event_time", ingest.parsed_time(F.col("date")))
    rows = ingest.resolve_measures(ingest.resolve_keys(rows.where("event_time IS NOT NULL"), star))
    if feed.isStreaming and delay:
        rows = rows.withWatermark("event_time", delay)
    return (
        rows.groupBy(F.window("event_time", window, startTime=start).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.sum("prepared_qty").alias("food_prepared"),
            F.sum("sold_qty").alias("food_sold"),
            F.sum("waste_qty").alias("food_wasted"),
            F.sum("waste_cost").cast("double").alias("waste_cost"),
            F.sum("revenue").cast("double").alias("revenue"),
        )
        .select(
            F.to_date("w.start").alias("window_start"),
            F.to_date("w.end").alias("window_end"),
            "record_count", "food_prepared", "food_sold", "food_wasted",
            exact.even_pct(F.col("food_wasted"), F.col("food_prepared"))
            .alias("waste_percentage"),
            "waste_cost", "revenue",
        )
    )


class _Previous(StatefulProcessor):
    """Remembers the food wasted in the last window of a key; windows of a key come in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", StructType([StructField("food_wasted", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        windows = pd.concat(rows).sort_values("window_start")
        before = self.last.get()[0] if self.last.exists() else 0
        windows["previous_food_wasted"] = [before, *windows["food_wasted"].tolist()[:-1]]
        self.last.update((int(windows["food_wasted"].iloc[-1]),))
        yield windows

    def close(self) -> None:
        pass


def warnings(windows: DataFrame) -> DataFrame:
    """A stream of closed windows with the change against the window that closed before each.

    The last total is state, so a batch reads nothing of earlier ones. The state's one key has one
    row for each window, whatever the number of facts.
    """
    schema = StructType([*windows.schema.fields, StructField("key", LongType()), StructField("previous_food_wasted", LongType())])
    keyed = windows.withColumn("key", F.lit(0).cast("bigint"))
    compared = keyed.groupBy("key").transformWithStateInPandas(
        _Previous(), outputStructType=schema, outputMode="Append", timeMode="None").drop("key")
    return compared.withColumn("waste_change_pct", changes.change_pct(
        F.col("food_wasted"), F.col("previous_food_wasted"))).withColumns({
            "change_display": changes.change_display(F.col("waste_change_pct")),
            "status": changes.warning_status(F.col("waste_change_pct"))})


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_windows(spark: SparkSession, windows: DataFrame, path: str, checkpoint: str) -> None:
    """Write closed windows with their warnings until no file is left; a restart goes on from the checkpoint."""
    usual = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        query = warnings(windows).writeStream.outputMode("append").format("parquet").option("path", path).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE_STORE, usual)
    query.awaitTermination()


def run_late_windows(spark: SparkSession, windows: DataFrame, path: str, checkpoint: str) -> None:
    """Write windows whenever their totals change, until no file is left.

    A row of any age rewrites its window: the batch writes the window's new version beside the
    earlier ones. A repeated batch overwrites its own versions.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = windows.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """The last version of each window, with the number of its versions."""
    stored = spark.read.parquet(path)
    totals = [c for c in stored.columns if c != "batch_id"]
    return stored.groupBy("window_start").agg(
        F.max_by(F.struct(*totals), "batch_id").alias("w"), F.count(F.lit(1)).alias("versions")).select("w.*", "versions")
