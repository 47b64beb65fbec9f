"""Structured Streaming: new files once, the ledger as keyed state, windows over events, verdicts as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from pagemill.operators.ledger import BROKEN


def read_stream(spark: SparkSession, folder: str, schema: StructType, glob: str = "*.parquet", files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", glob).parquet(folder)


def new_content(files: DataFrame, watermark: str | None = None, at: str = "ts") -> DataFrame:
    """Each content hash once; with a watermark, state older than it is dropped."""
    return files.dropDuplicates(["sha256"]) if watermark is None else files.withWatermark(at, watermark).dropDuplicatesWithinWatermark(["sha256"])


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Events and values by type and event-time window; what is later than ``late`` is dropped."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    g = events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


STANDING = "doc_id string, page_index int, status string, checksum string, last_seq long, attempts long"
_STATE = "status string, checksum string, last_seq long, kept_status string, kept_checksum string, kept_seq long, ever_ok boolean, attempts long, seen long"


class PageLedger(StatefulProcessor):
    """A document page's standing as keyed state, the one that ``ledger.fold`` gives for the same events in any order of arrival.

    Besides the last event the state has the last one that was not broken, and whether the page was ever ok: then the
    latter is the standing. Events up to the greatest number seen in earlier batches are replays and change nothing.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("standing", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        status, checksum, last, kept_status, kept_checksum, kept, ever_ok, attempts, seen = self.state.get() if self.state.exists() else ("", None, -1, "", None, -1, False, 0, -1)
        newest = seen
        for frame in rows:
            for r in frame.itertuples():
                if r.seq <= seen:
                    continue
                attempts += 1 if pd.isna(r.attempt) else int(r.attempt)
                ever_ok = ever_ok or r.status == "ok"
                newest = max(newest, int(r.seq))
                if r.seq > last:
                    status, checksum, last = r.status, r.checksum, int(r.seq)
                if r.status not in BROKEN and r.seq > kept:
                    kept_status, kept_checksum, kept = r.status, r.checksum, int(r.seq)
        self.state.update((status, checksum, last, kept_status, kept_checksum, kept, ever_ok, attempts, newest))
        now = (kept_status, kept_checksum, kept) if ever_ok else (status, checksum, last)
        yield pd.DataFrame({"doc_id": [key[0]], "page_index": [key[1]], "status": [now[0]], "checksum": [now[1]], "last_seq": [now[2]], "attempts": [attempts]})

    def close(self) -> None:
        pass


def ledger_stream(events: DataFrame) -> DataFrame:
    """Page events (doc_id, page_index, seq, status, checksum, attempt) -> the standing after each batch; later ones replace earlier ones.

    Its state needs the RocksDB store, which is set for the session.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return events.groupBy("doc_id", "page_index").transformWithStateInPandas(PageLedger(), STANDING, "Update", "None")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there, batch by batch, and stop; a restart goes on where the checkpoint is."""
    stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def table_after(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """An in-memory table of a bounded result after all that is available; for tests and small reports."""
    spark = stream.sparkSession
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def write_batches(stream: DataFrame, checkpoint: str, out: str, mode: str = "append") -> None:
    """Each batch as a partition of ``out`` of its own: a batch that is run again replaces itself, so nothing is twice."""

    def each(batch: DataFrame, k: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={k}")

    run_available(stream, checkpoint, each, mode)


def judge_until(spark: SparkSession, verdicts: DataFrame, checkpoint: str, target: int, out: str) -> None:
    """Verdicts as they arrive, up to ``target`` rows in all; one file folder and one count for each batch.

    A repeated batch replaces what it wrote before, and counts only the batches before it.
    """
    counts = f"{out}_counts"

    def each(batch: DataFrame, k: int) -> None:
        before = spark.read.schema("n long, batch int").option("recursiveFileLookup", "false").parquet(counts).filter(F.col("batch") < k).agg(F.sum("n")).first()[0] if k else 0
        kept = batch.orderBy("doc_id").limit(max(0, target - (before or 0)))
        kept.write.mode("overwrite").parquet(f"{out}/batch={k}")
        n = spark.read.schema(batch.schema).parquet(f"{out}/batch={k}").count()
        spark.createDataFrame([(n,)], "n long").write.mode("overwrite").parquet(f"{counts}/batch={k}")

    run_available(verdicts, checkpoint, each)


def metrics_events(pages: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events named parser.metrics.v1: pages, failures and milliseconds by window and route, from pages(ts, route, status, ms)."""
    g = pages.withWatermark("ts", late).groupBy(F.window("ts", size), "route").agg(F.count("*").alias("pages"), F.sum((F.col("status") != "ok").cast("long")).alias("failed"), F.avg("ms").alias("mean_ms"), F.max("ms").alias("max_ms"))
    payload = F.to_json(F.struct("route", "pages", "failed", "mean_ms", "max_ms"))
    return g.select(F.lit("parser.metrics.v1").alias("event"), F.col("window.end").alias("ts"), payload.alias("payload"))


def document_events(results: DataFrame) -> DataFrame:
    """Events of finished documents: document.parsed.v1, or document.parse_failed with the error. results(doc_id, status, ts, error)"""
    failed = F.col("status") == "failed"
    return results.select(F.when(failed, "document.parse_failed").otherwise("document.parsed.v1").alias("event"), "ts", F.to_json(F.struct("doc_id", "status", F.when(failed, F.col("error")).alias("error"))).alias("payload"))
