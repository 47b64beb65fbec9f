"""Scoring documents by weighted signals and sending them, and their pages, to a tier of extraction.

Signals are rows (doc_id, name, value double, status); a detector is a function from the feature table to such rows, so a
new one is one more function in ``DETECTORS``. A signal that is missing, failed or not applicable is not evidence of
absence: it adds nothing to the score and lowers the confidence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Weights of the signals; other known names weigh nothing.
WEIGHTS = {
    "metric_scanned_page_probability": 15.0,
    "metric_low_char_density": 8.0,
    "metric_ocr_required": 18.0,
    "metric_low_text_ratio": 12.0,
    "metric_image_density": 5.0,
    "metric_table_probability": 25.0,
    "metric_form_probability": 5.0,
    "metric_font_diversity": 15.0,
    "metric_multi_column_probability": 15.0,
    "metric_reading_order_ambiguity": 20.0,
    "metric_layout_complexity": 15.0,
    "metric_block_fragmentation": 2.0,
    "metric_table_present": 8.0,
}
# Tiers with their score bands, and the confidence below which the next tier takes over.
TIERS = (("native", 0, 30, 0.50), ("enrichment", 31, 60, 0.35), ("docling", 61, 100, 0.0))
POOR_TEXT, FULL_IMAGE = 30, 0.9
# Parts of the names of usual fonts.
USUAL_FONTS = ("helv", "times", "tiro", "nimbus", "arial", "courier", "symbol")
#: Sums in decimals do not depend on the order of rows, so neither do rounded scores.
EXACT = "decimal(28,12)"


def weights_table(spark: SparkSession, weights: dict[str, float] | None = None) -> DataFrame:
    return spark.createDataFrame(list((weights or WEIGHTS).items()), "name string, weight double")


def to_unit(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value.cast("double")))


def score(signals: DataFrame, weights: DataFrame, total_weight: float = sum(WEIGHTS.values())) -> DataFrame:
    """doc_id, score (0-100, half-even at 3), confidence (at 4), unknown: per document, the last ok signal of a name counts.

    signals(doc_id, place, name, value, status)
    """
    known = signals.join(F.broadcast(weights), "name", "left")  # the table of weights is a constant of the code
    ok = known.withColumn("_ok", (F.col("status") == "ok") & F.col("value").isNotNull() & F.col("weight").isNotNull())
    best = ok.withColumn("_r", F.when(F.col("_ok"), F.row_number().over(Window.partitionBy("doc_id", "name", "_ok").orderBy(F.desc("place")))))
    counts = F.col("_r") == 1
    per = best.groupBy("doc_id").agg(
        F.coalesce(F.sum(F.when(counts & (to_unit(F.col("value")) > 0), F.col("weight") * to_unit(F.col("value"))).cast(EXACT)).cast("double"), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(F.when(counts, F.col("weight"))), F.lit(0.0)).alias("measured"),
        F.sum(F.when(F.col("weight").isNull(), 1).otherwise(0)).alias("unknown"),
    )
    out = per.withColumn("all_weight", F.lit(total_weight))
    return out.select("doc_id", F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("s"))), 3).alias("score"), F.bround(F.col("measured") / F.col("all_weight"), 4).alias("confidence"), "unknown")


def tier(score_: Column, confidence: Column) -> Column:
    """Band of the truncated score, one tier up where confidence is below the band's threshold."""
    s = score_.cast("int")
    out = None
    for k, (name, lo, hi, least) in enumerate(TIERS):
        above = TIERS[min(k + 1, len(TIERS) - 1)][0]
        choice = F.when(confidence < least, above).otherwise(name)
        out = F.when(s.between(lo, hi), choice) if out is None else out.when(s.between(lo, hi), choice)
    return out.otherwise(TIERS[-1][0])


def decide(signals: DataFrame, weights: DataFrame) -> DataFrame:
    """Score, confidence and tier; a document without any signal can't be inspected: native, 0, 0.05."""
    d = score(signals, weights)
    seen = signals.groupBy("doc_id").agg(F.count("name").alias("n"))
    d = d.join(seen, "doc_id").withColumns({"confidence": F.when(F.col("n") == 0, F.lit(0.05)).otherwise(F.col("confidence"))})
    return d.withColumn("route", F.when(F.col("n") == 0, "native").otherwise(tier(F.col("score"), F.col("confidence")))).drop("n")


def statistics(decisions: DataFrame) -> DataFrame:
    """Counts by tier, score decade and confidence decile."""
    return decisions.groupBy("route", F.floor(F.col("score") / 10).alias("score_bucket"), F.floor(F.col("confidence") * 10).alias("confidence_bucket")).agg(F.count("*").alias("n"))


def page_tier(document: Column, has_table: Column, simple_grid: Column, needs_ocr: Column, heavy: bool = True) -> Column:
    """Tier of one page: tables go to the heavy tier unless the grid is simple, pages without text to recognition."""
    top = "docling" if heavy else "enrichment"
    return F.when(document == "native", "native").when(has_table & ~simple_grid, top).when(needs_ocr, "enrichment").otherwise("native")


def majority_tier(pages: DataFrame) -> DataFrame:
    """A document's tier from its pages': recognition before tables before native, where they are half of the pages or more."""
    share = lambda x: F.avg(F.when(F.col("page_route") == x, 1.0).otherwise(0.0))
    return pages.groupBy("doc_id").agg(F.when(share("ocr") >= 0.5, "ocr").when(share("table") >= 0.5, "table").otherwise("native").alias("route"))


def reasons(signals: DataFrame, weights: DataFrame) -> DataFrame:
    """What a document's weighted signals say, the first eight in the detectors' order.

    Of a name the first row counts: strong evidence is told with its value, a missing or failed one as not measured.
    Names without a positive weight are not told. signals(doc_id, place, name, value, status)
    """
    told = F.when(is_strong(F.col("status"), F.col("value")), F.concat(F.lit("high "), "name", F.lit(" ("), F.format_string("%.2f", F.col("value").cast("double")), F.lit(")")))
    told = told.when(F.col("status").isin("missing", "failed"), F.concat("name", F.lit(" not measured ("), "status", F.lit(")")))
    positive = F.broadcast(weights.filter(F.col("weight") > 0).select("name", F.lit(True).alias("_weighted")))
    row = F.struct("place", told.alias("t"))
    per = signals.join(positive, "name", "left").groupBy("doc_id", "name").agg(F.min(F.when(F.col("_weighted"), row)).alias("r"))
    kept = F.array_sort(F.collect_list(F.when(F.col("r.t").isNotNull(), F.col("r"))))
    return per.groupBy("doc_id").agg(F.slice(F.transform(kept, lambda x: x.t), 1, 8).alias("reasons"))


def _signal(name: str, value: Column, applies: Column | None = None, known: Column | None = None) -> Column:
    status = F.when(~applies, "not_applicable") if applies is not None else F.when(F.lit(False), "")
    status = status.when(~known, "missing") if known is not None else status
    status = status.when(value.isNull(), "missing").otherwise("ok")
    return F.struct(F.lit(f"metric_{name}").alias("name"), F.when(status == "ok", value.cast("double")).alias("value"), status.alias("status"))


#: Feature columns that a table need not have; without them their signals are missing.
OPTIONAL = {"text_ratio": "double", "images": "long", "pdf_version": "double", "encrypted": "boolean", "has_outline": "boolean", "has_tag": "boolean", "producer": "string"}


def _given(name: str) -> Column:
    return F.col(name).cast(OPTIONAL[name])


def _rounded(x: Column) -> Column:
    """At most 1, half-even at 3; least() alone would pass over a null."""
    return F.when(x.isNotNull(), F.bround(F.least(F.lit(1.0), x), 3))


# Features of a document: pages, chars array<long> (per page), blocks array<long>, image_ratio array<double>, columns long (pages
# with several columns), tables long, fonts array<string>, mean_line double
def _mean(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.greatest(F.size(x), F.lit(1))


def _share(x: Column, test) -> Column:
    return F.size(F.filter(x, test)) / F.greatest(F.size(x), F.lit(1))


def text_detector() -> list[Column]:
    chars = F.col("chars")
    total = F.aggregate(chars, F.lit(0).cast("long"), lambda a, v: a + v)
    least = F.array_min(chars)
    density = F.when(total == 0, 1.0).when(least >= POOR_TEXT, 0.0).otherwise(1 - least / 2000)
    return [
        _signal("total_char_count", total), _signal("char_per_page", F.bround(total / F.greatest(F.col("pages"), F.lit(1)), 2)), _signal("text_ratio", F.bround(_given("text_ratio"), 4)),
        _signal("low_text_ratio", F.bround(_share(chars, lambda c: c < POOR_TEXT), 3)), _signal("low_char_density", F.bround(density, 3)),
    ]


def image_detector() -> list[Column]:
    bare = F.filter(F.arrays_zip("image_ratio", "chars"), lambda x: x.chars == 0)
    scanned = F.coalesce(F.array_max(F.transform(bare, lambda x: x.image_ratio)), F.lit(0.0))
    n = _given("images")
    return [
        _signal("image_count", n), _signal("images_per_page", F.bround(n / F.greatest(F.col("pages"), F.lit(1)), 3)),
        _signal("full_image_page_count", F.size(F.filter("image_ratio", lambda r: r >= FULL_IMAGE))),
        _signal("image_density", F.bround(F.least(F.lit(1.0), _mean(F.col("image_ratio"))), 3)), _signal("scanned_page_probability", F.bround(scanned, 3)),
    ]


def layout_detector() -> list[Column]:
    share = F.col("columns") / F.greatest(F.col("pages"), F.lit(1))
    return [
        _signal("multi_column_probability", F.bround(share, 3)),
        _signal("layout_complexity", _rounded(F.array_max("blocks") / 40)),
        _signal("block_fragmentation", F.bround(F.least(F.lit(1.0), _mean(F.col("blocks").cast("array<double>")) / 40 + share), 3)),
    ]


def ocr_detector() -> list[Column]:
    poor, full = _share(F.col("chars"), lambda c: c < POOR_TEXT), _share(F.col("image_ratio"), lambda r: r >= FULL_IMAGE)
    return [_signal("ocr_required", F.bround(F.least(F.lit(1.0), 0.6 * poor + 0.4 * full), 3), applies=(poor > 0) | (full > 0))]


def table_detector() -> list[Column]:
    n = F.col("tables")
    return [_signal("table_present", F.when(n > 0, 1.0).when(n.isNotNull(), 0.0)), _signal("table_probability", _rounded(n / 3))]


def form_detector() -> list[Column]:
    value = 0.5 * F.least(F.lit(1.0), _mean(F.col("blocks").cast("array<double>")) / 40) + 0.5 * F.greatest(F.lit(0.0), (20 - F.col("mean_line")) / 20)
    return [_signal("form_probability", F.bround(value, 3), known=F.exists("chars", lambda c: c > 0))]


def reading_order_detector() -> list[Column]:
    share = F.col("columns") / F.greatest(F.col("pages"), F.lit(1))
    return [_signal("reading_order_ambiguity", F.bround(F.least(F.lit(1.0), 0.7 * share + 0.3 * F.least(F.lit(1.0), _mean(F.col("blocks").cast("array<double>")) / 40)), 3))]


def font_detector() -> list[Column]:
    usual = lambda f: F.exists(F.array(*map(F.lit, USUAL_FONTS)), lambda u: F.contains(F.lower(f), u))
    some = F.size("fonts") > 0
    return [
        _signal("font_diversity", F.bround(F.least(F.lit(1.0), F.size("fonts") / 8), 3), applies=some),
        _signal("unusual_font", F.exists("fonts", lambda f: ~usual(f)).cast("double"), applies=some), _signal("font_embedded", some.cast("double"), applies=some),
    ]


def metadata_detector() -> list[Column]:
    """Presence of a file's own data; a version counts as its number, a producer only where there is one."""
    flag = lambda c: _given(c).cast("boolean").cast("double")
    version = _given("pdf_version").cast("double")
    made_by = F.when(F.coalesce(_given("producer"), F.lit("")) != "", 1.0)
    return [
        _signal("foundation_meta_available", version.isNotNull().cast("double")), _signal("pdf_version", version), _signal("encrypted", flag("encrypted")),
        _signal("producer_present", made_by), _signal("has_outline", flag("has_outline")), _signal("has_tag", flag("has_tag")),
        _signal("title_present", F.when(F.col("title") != "", 1.0).when(F.col("title").isNotNull(), 0.0)),
    ]


DETECTORS: dict[str, Callable[[], list[Column]]] = {
    "metadata": metadata_detector, "text": text_detector, "image": image_detector, "layout": layout_detector, "ocr": ocr_detector,
    "table": table_detector, "form": form_detector, "reading_order": reading_order_detector, "font": font_detector,
}


def register_detector(name: str, detector: Callable[[], list[Column]]) -> None:
    DETECTORS[name] = detector


def detect(features: DataFrame) -> DataFrame:
    """Feature rows -> signal rows, in the detectors' order; one projection, no join.

    A detector that can't be built, or doesn't fit the table, gives one signal with status failed and stops no other.
    """
    features = features.withColumns({c: F.lit(None).cast(t) for c, t in OPTIONAL.items() if c not in features.columns})
    every: list[Column] = []
    for name, detector in DETECTORS.items():
        try:
            signals = detector()
            features.select(*signals)  # resolves the columns; nothing is run
        except Exception:  # noqa: BLE001 - whatever a plugged-in detector does wrong is its own failure
            signals = [F.struct(F.lit("metric_detector_failed").alias("name"), F.lit(None).cast("double").alias("value"), F.lit("failed").alias("status"))]
        every += [F.struct(F.lit(name).alias("detector"), s["name"].alias("name"), s["value"].alias("value"), s["status"].alias("status")) for s in signals]
    return features.select("doc_id", F.posexplode(F.array(*every)).alias("place", "s")).select("doc_id", "place", "s.*")


def decision_records(signals: DataFrame, weights: DataFrame, scorer: Callable[[DataFrame, DataFrame], DataFrame] = score) -> DataFrame:
    """Decisions as records: score, confidence, route, unknown, reasons, signals by status, and whether a detector failed.

    ``scorer`` may be any function with the arguments and columns of ``score``.
    """
    status = [F.sum((F.col("status") == x).cast("int")).alias(f"n_{x}") for x in ("ok", "missing", "failed", "not_applicable")]
    states = signals.groupBy("doc_id").agg(*status, F.count("name").alias("_n"))
    d = scorer(signals, weights).join(states, "doc_id").join(reasons(signals, weights), "doc_id", "left")
    d = d.withColumn("confidence", F.when(F.col("_n") == 0, F.lit(0.05)).otherwise(F.col("confidence")))
    return d.withColumn("route", F.when(F.col("_n") == 0, "native").otherwise(tier(F.col("score"), F.col("confidence")))).withColumn("detector_failed", F.col("n_failed") > 0).drop("_n")


def is_evidence(status: Column, value: Column) -> Column:
    return (status == "ok") & value.isNotNull()


def is_strong(status: Column, value: Column, least: float = 0.5) -> Column:
    return is_evidence(status, value) & (value >= least)
