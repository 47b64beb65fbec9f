"""The page ledger as an append-only table, and everything that is read off it: plans, retries, assembly, completeness."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROKEN = ("failed", "dead")


def fold(events: DataFrame) -> DataFrame:
    """doc_id, page_index, seq, status, checksum, attempt -> the page's standing: last state, summed attempts.

    A page that was ok stays ok: a failure after it is counted as an attempt, not as the state.
    """
    later = F.struct((~F.col("status").isin(*BROKEN)).cast("int").alias("whole"), "seq")
    ever_ok = F.max((F.col("status") == "ok").cast("int")) == 1
    last = F.max_by(F.struct("status", "checksum", "seq"), F.col("seq"))
    kept = F.max_by(F.struct("status", "checksum", "seq"), later)
    g = events.groupBy("doc_id", "page_index").agg(F.when(ever_ok, kept).otherwise(last).alias("s"), F.sum(F.coalesce("attempt", F.lit(1))).alias("attempts"))
    return g.select("doc_id", "page_index", "s.status", "s.checksum", F.col("s.seq").alias("last_seq"), "attempts")


def is_assembled(status: Column, content: Column, n_errors: Column) -> Column:
    return (status.isin("ok", "partial") & content) | ((status == "ok") & ~content & (n_errors == 0))


def content_present(n_blocks: Column, n_tables: Column, n_images: Column) -> Column:
    return (n_blocks > 0) | (n_tables > 0) | (n_images > 0)


def assembly(expected: DataFrame, results: DataFrame) -> DataFrame:
    """Per document: pages expected, present, missing, failed, dead, and whether it is whole.

    expected(doc_id, page_index), results(doc_id, page_index, status, content_present, n_errors)
    """
    ok = is_assembled(F.col("status"), F.col("content_present"), F.col("n_errors"))
    r = results.select("doc_id", "page_index", "status", ok.alias("ok"))
    both = expected.withColumn("wanted", F.lit(True)).join(r, ["doc_id", "page_index"], "full")
    pages = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("page_index"))))
    wanted, got = F.coalesce("wanted", F.lit(False)), F.coalesce("ok", F.lit(False))
    a = both.groupBy("doc_id").agg(
        F.sum(wanted.cast("int")).alias("expected_pages"), F.sum(got.cast("int")).alias("actual_pages"), pages(wanted & ~got).alias("missing_pages"),
        pages(F.col("status") == "failed").alias("failed_pages"), pages(F.col("status") == "dead").alias("dead_pages"), F.sum((got & ~wanted).cast("int")).alias("extra"),
    )
    broken = (F.size("missing_pages") > 0) | (F.size("failed_pages") > 0) | (F.size("dead_pages") > 0)
    status = F.when(~broken, "ok").when(F.col("actual_pages") > 0, "partial").otherwise("failed")
    return a.withColumns({"status": status, "complete": (F.size("missing_pages") == 0) & (F.col("extra") == 0)}).drop("extra")


def plan(expected: DataFrame, standing: DataFrame) -> DataFrame:
    """Pages to do: those without a standing, and those that are not ok, with their next attempt."""
    s = standing.select("doc_id", "page_index", "status", "attempts")
    j = expected.join(s, ["doc_id", "page_index"], "left").filter(F.coalesce("status", F.lit("new")) != "ok")
    return j.select("doc_id", "page_index", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempt"))


def run_with_retries(pages: DataFrame, engine: Callable[[DataFrame], DataFrame], save: Callable[[DataFrame, str], DataFrame], rounds: int = 2) -> DataFrame:
    """Results of ``engine`` over pages, failures tried again, then dead.

    An engine returns a row for each page and never raises for one. ``save`` writes a round where every executor can
    read it, so that a lost executor repeats no finished round.
    """
    done = save(engine(pages), "round-0")
    for k in range(1, rounds + 1):
        failed = done.filter(F.col("status") == "failed").select(*pages.columns)
        again = save(engine(failed.withColumn("attempt", F.col("attempt") + 1) if "attempt" in failed.columns else failed), f"round-{k}")
        done = done.join(again.select("doc_id", "page_index"), ["doc_id", "page_index"], "left_anti").unionByName(again, allowMissingColumns=True)
    return done.withColumn("status", F.when(F.col("status") == "failed", "dead").otherwise(F.col("status")))


def safety_net(expected: DataFrame, results: DataFrame) -> DataFrame:
    """A row for each expected page; what no engine returned has failed."""
    return expected.join(results, ["doc_id", "page_index"], "left").withColumn("status", F.coalesce("status", F.lit("failed")))


def conversion_status(status: Column, expected: Column, produced: Column, n_errors: Column) -> Column:
    """What a converter's answer means: failure or skipping, or part of nothing, is a failed page."""
    s = F.upper(status)
    return F.when(s.isin("FAILURE", "SKIPPED") | ((s == "PARTIAL_SUCCESS") & (produced == 0)), "failed").when((s == "PARTIAL_SUCCESS") | (produced < expected) | (n_errors > 0), "partial").otherwise("ok")


def pending(files: DataFrame, manifest: DataFrame, key: str = "sha256") -> DataFrame:
    """Files not yet known; one of several with the same content; a null hash stays pending."""
    new = files.join(manifest.select(key).distinct(), key, "left_anti")
    first = F.row_number().over(Window.partitionBy(key).orderBy("path"))
    return new.withColumn("_k", F.when(F.col(key).isNull(), 1).otherwise(first)).filter(F.col("_k") == 1).drop("_k")


def upsert_manifest(old: DataFrame, new: DataFrame, key: str, stratum: str, cap: int) -> DataFrame:
    """The manifest with new rows of unknown key, up to ``cap`` rows a stratum; old rows are never dropped."""
    fresh = new.dropDuplicates([key]).join(old.select(key), key, "left_anti").withColumn("_new", F.lit(1))
    both = old.withColumn("_new", F.lit(0)).unionByName(fresh)
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("_new", key))
    return both.withColumn("_r", rank).filter((F.col("_new") == 0) | (F.col("_r") <= cap)).drop("_new", "_r")


def shard(text: Column, n: int) -> Column:
    """First 32 bits of sha256, modulo n."""
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("bigint") % n


def batch_report(results: DataFrame) -> DataFrame:
    """Counts by format and status, with pages and rates where they were measured."""
    secs = F.sum("seconds")
    return results.groupBy("format").agg(
        F.count("*").alias("total"), *[F.sum((F.col("status") == s).cast("int")).alias(s) for s in ("ok", "failed", "skipped")], F.sum("pages").alias("pages"),
        F.when(secs > 0, F.sum("pages") / secs).alias("pages_per_second"), F.when(secs > 0, F.count("*") / secs).alias("docs_per_second"),
    )


def workers(ram: Column, overhead: Column, per_worker: Column, share: float = 0.8) -> Column:
    return F.greatest(F.lit(1), F.floor((ram * share - overhead) / per_worker).cast("int"))
