"""Quality analytics: means by several rules, percentiles by several definitions, samples, comparisons, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.operators.ranking import at_rank, ranked


def percentiles(df: DataFrame, by: Sequence[str], value: str, at: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Linear interpolation at q * (n - 1); nulls don't count."""
    r = ranked(df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull()), by, ["_v"])

    def one(q: float) -> Column:
        lo, hi = (at_rank("_v", f(q * (F.col("_n") - 1)).cast("long")) for f in (F.floor, F.ceil))
        pos = F.max(q * (F.col("_n") - 1))
        return F.when(lo == hi, lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi).alias(f"p{round(q * 100)}")

    return r.groupBy(*by).agg(*map(one, at))


def upper_median(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Element n // 2 of the sorted values."""
    return ranked(df.select(*by, value).filter(F.col(value).isNotNull()), by, [value]).groupBy(*by).agg(at_rank(value, F.floor(F.col("_n") / 2)).alias("upper_median"))


def exclusive_p95(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Position 0.95 * (n + 1) between sorted values; the largest where there are fewer than 20."""
    r = ranked(df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull()), by, ["_v"])
    at = F.lit(0.95) * (F.col("_n") + 1)
    k = F.greatest(F.lit(1), F.least(F.floor(at).cast("int"), F.col("_n") - 1))
    g = r.groupBy(*by).agg(F.max("_n").cast("int").alias("n"), F.max("_v").alias("most"), F.max(at - k).alias("part"), at_rank("_v", k - 1).alias("lo"), at_rank("_v", k).alias("hi"), F.sum("_v").alias("total"))
    inner = F.col("lo") + F.col("part") * (F.col("hi") - F.col("lo"))
    return g.select(*by, F.when(F.col("n") < 20, F.col("most")).otherwise(inner).alias("p95"), "total", "n")


def metric_means(df: DataFrame, metrics: Sequence[str], by: str) -> DataFrame:
    """Mean of each metric over rows that have it, for each value of ``by`` and for all, in one pass."""
    return df.rollup(by).agg(
        F.grouping(by).cast("int").alias("all_groups"), F.count("*").alias("n"),
        *[F.bround(F.avg(m), 4).alias(f"mean_{m}") for m in metrics], *[F.count(m).alias(f"n_{m}") for m in metrics],
        *[F.bround(F.sum(F.coalesce(m, F.lit(0.0))) / F.count("*"), 4).alias(f"zero_mean_{m}") for m in metrics],
    )


def verdict(label: Column) -> Column:
    v = F.upper(F.trim(label))
    return F.when(v.contains("PASS_WITH_ISSUES"), "PASS_WITH_ISSUES").when(v.contains("PASS"), "PASS").when(v.contains("FAIL"), "FAIL").otherwise("UNKNOWN")


def verdict_rates(df: DataFrame, label: str, by: Sequence[str]) -> DataFrame:
    v = verdict(F.col(label))
    n = lambda x: F.sum(F.when(v == x, 1).otherwise(0))
    return df.groupBy(*by).agg(F.count("*").alias("n"), n("PASS").alias("passed"), n("PASS_WITH_ISSUES").alias("with_issues"), (F.count("*") - n("PASS") - n("PASS_WITH_ISSUES")).alias("failed"), F.bround((n("PASS") + n("PASS_WITH_ISSUES")) / F.count("*"), 4).alias("acceptance"))


def issue_cube(issues: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by both, by each, and of all."""
    return issues.cube(a, b).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"))


def step_sample(df: DataFrame, stratum: str, order: Sequence[str], size: int) -> DataFrame:
    """From each stratum the rows int(i * n / size), i = 0 … size - 1; all rows of smaller strata."""
    r = ranked(df, [stratum], list(order))
    # row r is picked if some i has floor(i * n / size) = r: the least i that reaches r is ceil(r * size / n)
    i = F.ceil(F.col("_rank") * size / F.col("_n"))
    hit = (i < size) & (F.floor(i * F.col("_n") / size) == F.col("_rank"))
    return r.filter((F.col("_n") <= size) | hit).drop("_rank", "_n")


def quota_sample(df: DataFrame, stratum: str, order: Sequence[str], total: int, exact: bool = False) -> DataFrame:
    """The first rows of each stratum, by its share of ``total`` (half-even).

    With ``exact``, rows are added in order, or taken off the end of the last strata, until there are ``total``. No stratum
    gives more than ``total``, which bounds what leaves a task.
    """
    sizes = df.groupBy(stratum).agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("_quota", F.bround(F.lit(float(total)) * F.col("_n") / F.sum("_n").over(Window.partitionBy()))).withColumnRenamed(stratum, "_stratum")
    first = df.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).filter(F.col("_r") <= total)
    quota = first.join(sizes, F.col(stratum).eqNullSafe(F.col("_stratum"))).withColumn("_in", F.col("_r") <= F.col("_quota"))
    if not exact:
        return quota.filter("_in").select(*df.columns)
    # those within quota by stratum, then the others in order: the first ``total`` of this list
    return quota.orderBy(F.desc("_in"), F.when(F.col("_in"), F.col("_stratum")), F.when(F.col("_in"), F.col("_r")), *order).limit(total).select(*df.columns)


def first_per(df: DataFrame, by: Sequence[str], order: Sequence, n: int) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


def compare_runs(a: DataFrame, b: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Full outer join of two runs; for each field whether both sides are the same, nulls being equal."""
    left, right = (x.select(F.col(key).alias(f"{s}_{key}"), *[F.col(f).alias(f"{s}_{f}") for f in fields]) for s, x in (("a", a), ("b", b)))
    j = left.join(right, F.col(f"a_{key}") == F.col(f"b_{key}"), "full")
    where = F.when(F.col(f"b_{key}").isNull(), "only_a").when(F.col(f"a_{key}").isNull(), "only_b").otherwise("both")
    same = [F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")).alias(f"same_{f}") for f in fields]
    return j.select(F.coalesce(f"a_{key}", f"b_{key}").alias(key), where.alias("found_in"), *[c for f in fields for c in (f"a_{f}", f"b_{f}")], *same)


def percent_change(new: Column, old: Column) -> Column:
    """Null without a base."""
    return F.when(old.isNotNull() & (old != 0), 100.0 * (new - old) / old)


def set_relations(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of the union with where they are from: both, a, b."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.intersect(y).withColumn("side", F.lit("both")).unionByName(x.subtract(y).withColumn("side", F.lit("a"))).unionByName(y.subtract(x).withColumn("side", F.lit("b")))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("(?U)\\w+"), F.lit(0))


def ngrams(xs: Column, n: int) -> Column:
    return F.when(F.size(xs) >= n, F.transform(F.sequence(F.lit(1), F.size(xs) - (n - 1)), lambda i: F.slice(xs, i, F.lit(n)))).otherwise(F.array().cast("array<array<string>>"))


def repetition(docs: DataFrame, n: int = 4) -> DataFrame:
    """Share of surplus occurrences among a text's n-grams; 0 below 50 words. Suspicious above 0.25."""
    w = docs.select("doc_id", words_of(F.col("text")).alias("w"))
    # as strings, so that equal ones are found by hash; a document is looked at alone and nothing is shuffled
    grams = F.when(F.size("w") >= 50, F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.array_join(F.slice("w", i, F.lit(n)), " ")))
    out = w.select("doc_id", F.size("w").alias("n_words"), grams.alias("g"))
    score = F.coalesce((F.size("g") - F.size(F.array_distinct("g"))) / F.size("g"), F.lit(0.0))
    return out.select("doc_id", "n_words", F.when(F.col("g").isNull(), 0.0).otherwise(score).alias("repetition")).withColumn("suspicious", F.col("repetition") > 0.25)


def text_hash(text: Column) -> Column:
    """sha256 of the words joined by single spaces."""
    return F.sha2(F.trim(F.regexp_replace(text, "(?U)[\\s\\x1C-\\x1F]+", " ")), 256)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Each document with its text's hash, the first document that has it, and how many do."""
    h = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"))
    groups = h.groupBy("text_hash").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))
    return h.join(groups, "text_hash").withColumn("is_duplicate", F.col("doc_id") != F.col("first_doc")).select("doc_id", "text_hash", "first_doc", "copies", "is_duplicate")


def recurring_lines(docs: DataFrame, edge: int = 3, least: int = 2, longer_than: int = 4) -> DataFrame:
    """Lines among the first and last ``edge`` lines of several pages (here: paragraph blocks) of a document."""
    lines = F.filter(F.transform(F.split("page", "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    pages = docs.select("doc_id", F.posexplode(F.split("text", "\n\n", -1)).alias("page_no", "page")).select("doc_id", "page_no", lines.alias("ls"))
    ends = F.array_distinct(F.concat(F.slice("ls", 1, edge), F.slice("ls", F.greatest(F.size("ls") - (edge - 1), F.lit(1)), edge)))
    each = pages.select("doc_id", F.explode(ends).alias("line")).filter(F.length("line") > longer_than)
    return each.groupBy("doc_id", "line").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least)


def similar_pairs(units: DataFrame, threshold: float, rows: int = 40) -> DataFrame:
    """Pairs of units (id, grams: array) by Jaccard similarity, from an inverted index; the top ``rows`` are the report.

    Lists are joined on the gram, so pairs that share nothing never meet.
    """
    g = units.select("id", F.size("grams").alias("n"), F.explode("grams").alias("g"))
    b = g.select(F.col("id").alias("id_b"), F.col("n").alias("n_b"), "g")
    both = g.join(b, "g").filter(F.col("id") < F.col("id_b")).groupBy("id", "id_b", "n", "n_b").agg(F.count("*").alias("c"))
    score = F.col("c") / (F.col("n") + F.col("n_b") - F.col("c"))
    return both.select("id", "id_b", score.alias("jaccard")).filter(F.col("jaccard") >= threshold).orderBy(F.desc("jaccard"), "id", "id_b").limit(rows)


#: Similarities at which ``similar_sets`` looks first: pairs that fill the report there leave no place for others.
STEPS = (0.95, 0.8, 0.6)


def similar_sets(units: DataFrame, threshold: float, rows: int = 40) -> DataFrame:
    """As ``similar_pairs``, for sets of which many are equal or share common grams (as 64-bit hashes); the same rows.

    Equal sets are folded; if their pairs (similarity 1) fill the report, no other pair can enter it. Other sets meet where
    their prefixes do: with the rarest grams first, two sets of the similarity share one of the first n - ceil(t * n) + 1
    grams, so common grams are left out without losing a pair. Then the similarity is counted on the whole sets. Higher
    similarities have shorter prefixes and are tried first.
    """
    hashed = units.select("id", F.sort_array(F.array_distinct(F.transform("grams", lambda g: F.xxhash64(g)))).alias("gs"))
    c = hashed.groupBy("gs").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "ids", "gs", F.size("gs").alias("n")).persist()
    c = c.filter(F.col("n") > 0)  # not before: a filter below would make all grams again
    order = (F.desc("jaccard"), "id", "id_b")
    follows = c.filter(F.size("ids") > 1).select("ids", F.posexplode("ids").alias("at", "id")).filter(F.col("at") + 1 < F.size("ids"))
    same = follows.select("id", F.slice("ids", F.col("at") + 2, F.lit(rows)).alias("later")).orderBy("id").limit(rows)
    same = same.select("id", F.explode("later").alias("id_b"), F.lit(1.0).alias("jaccard")).orderBy(*order).limit(rows)
    if same.count() == rows:
        return same
    each = c.select("rep", "n", F.explode("gs").alias("g"))
    order_of = F.transform(F.array_sort(F.collect_list(F.struct("df", "g"))), lambda x: x.g)
    ranked = each.join(each.groupBy("g").agg(F.count("*").alias("df")), "g").groupBy("rep", "n").agg(order_of.alias("o")).persist()
    a, b = c.select("rep", "ids", "gs"), c.select(F.col("rep").alias("rep_b"), F.col("ids").alias("ids_b"), F.col("gs").alias("gs_b"))

    def best(least: float) -> DataFrame:
        """The first ``rows`` of all pairs from ``least`` on."""
        first = ranked.select("rep", "n", F.explode(F.slice("o", F.lit(1), F.col("n") - F.ceil(F.col("n") * least - 1e-9).cast("int") + 1)).alias("g"))
        other = first.select(F.col("rep").alias("rep_b"), F.col("n").alias("n_b"), "g")
        near = (F.col("rep") < F.col("rep_b")) & (F.least("n", "n_b") >= F.greatest("n", "n_b") * least - 1e-9)
        met = first.join(other, "g").filter(near).select("rep", "rep_b").distinct()
        score = met.join(a, "rep").join(b, "rep_b").select("ids", "ids_b", jaccard(F.col("gs"), F.col("gs_b")).alias("jaccard")).filter(F.col("jaccard") >= least)
        # of two classes' pairs the first ``rows`` are among the first ``rows`` members of each
        pairs = score.select("jaccard", "ids_b", F.explode(F.slice("ids", 1, rows)).alias("x")).select("jaccard", "x", F.explode(F.slice("ids_b", 1, rows)).alias("y"))
        return pairs.select(F.least("x", "y").alias("id"), F.greatest("x", "y").alias("id_b"), "jaccard").unionByName(same).orderBy(*order).limit(rows)

    for least in STEPS:
        if least > threshold:
            found = best(least).persist()
            if found.count() == rows:
                return found
    return best(threshold)


def jaccard(a: Column, b: Column) -> Column:
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def conditional_mean(value: Column) -> Column:
    """Mean of the positive values alone."""
    return F.avg(F.when(value > 0, value))


def paired_means(pairs: DataFrame, before: str, after: str) -> DataFrame:
    """Means of two maps of metrics over the pairs in which either has a value other than 0, and the rounded change."""
    some = lambda m: F.exists(F.map_values(m), lambda x: x != 0)
    used = pairs.filter(some(before) | some(after))
    each = used.select(F.explode(F.map_keys(before)).alias("metric"), before, after)
    mean = lambda m: F.bround(100 * F.avg(F.coalesce(F.element_at(m, F.col("metric")), F.lit(0.0))), 2)
    out = each.groupBy("metric").agg(F.count("*").alias("n"), mean(before).alias("before"), mean(after).alias("after"))
    return out.withColumn("change", F.bround(F.col("after") - F.col("before"), 2))


def is_hard(table_pages: Column, ocr_pages: Column, column_pages: Column, confidence: Column, least: float = 0.80) -> Column:
    """Documents with tables or recognised pages, or with columns that were detected without confidence."""
    return (F.size(table_pages) > 0) | (F.size(ocr_pages) > 0) | ((F.size(column_pages) > 0) & (confidence < least))


def is_low(verdict: Column, metrics: Column, threshold: float, besides: Sequence[str] = ("tables", "scans_ocr")) -> Column:
    """Failed, or any measured metric but ``besides`` below the threshold."""
    low = F.exists(F.map_entries(metrics), lambda m: ~m.key.isin(*besides) & F.coalesce(m.value < threshold, F.lit(False)))
    return (F.upper(verdict) == "FAIL") | F.coalesce(low, F.lit(False))


def priority(rules: Sequence[tuple[Column, int]]) -> Column:
    """Sum of the points of the rules that hold."""
    return sum((F.when(c, n).otherwise(0) for c, n in rules[1:]), F.when(rules[0][0], rules[0][1]).otherwise(0))


def most_urgent(df: DataFrame, score: Column, order: Sequence[str], least: int = 6, rows: int = 250) -> DataFrame:
    """The report of the ``rows`` highest scores from ``least`` on, in order on ties."""
    return df.withColumn("score", score).filter(F.col("score") >= least).orderBy(F.desc("score"), *order).limit(rows)


def with_manifest(files: DataFrame, manifest: DataFrame, key: str = "sha256") -> DataFrame:
    """Files with what the manifest says of their content, one entry a content; files of unknown or no content are left out."""
    return files.join(manifest.filter(F.col(key).isNotNull()).dropDuplicates([key]), key)


def slice_rows(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def deterministic(runs: DataFrame, key: str, digest: str) -> DataFrame:
    """Of each key the number of runs, of distinct results, and whether there is just one."""
    return runs.groupBy(key).agg(F.count("*").alias("runs"), F.countDistinct(digest).alias("results")).withColumn("deterministic", F.col("results") == 1)


def first_seen(items: DataFrame, key: str, item: str, place: str) -> DataFrame:
    """A key's distinct items in the order in which they first occur; those without a place last, those with one place by name, null last."""
    first = items.groupBy(key, item).agg(F.min(place).alias("_at"))
    ordered = F.array_sort(F.collect_list(F.struct(F.isnull("_at").alias("_placeless"), "_at", F.isnull(item).alias("_nameless"), F.col(item).alias("_item"))))
    return first.groupBy(key).agg(F.transform(ordered, lambda x: x["_item"]).alias("items"))


def peaks(samples: DataFrame, run: str, at: str, measures: Sequence[str], window: str = "1 hour") -> DataFrame:
    """The largest value of each measure by run and window, and (window null) by run."""
    by_window = samples.groupBy(run, F.window(at, window).start.alias("window_start")).agg(*[F.max(m).alias(m) for m in measures])
    return by_window.unionByName(samples.groupBy(run).agg(*[F.max(m).alias(m) for m in measures]).withColumn("window_start", F.lit(None).cast(samples.schema[at].dataType)))


def run_metrics(pages: DataFrame, by: Sequence[str]) -> DataFrame:
    """Pages, and counts by route and by status, of each group, from pages(route, status, ...)."""
    per = pages.groupBy(*by, "route", "status").agg(F.count("*").alias("n"))
    count = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n"))))
    routes = per.groupBy(*by, "route").agg(F.sum("n").alias("n")).groupBy(*by).agg(F.sum("n").alias("pages"), count("route").alias("by_route"))
    return routes.join(per.groupBy(*by, "status").agg(F.sum("n").alias("n")).groupBy(*by).agg(count("status").alias("by_status")), list(by))


def rates(documents: DataFrame, pages: DataFrame, by: Sequence[str]) -> DataFrame:
    """Documents, pages, seconds, ms a page, pages and documents a second: documents(doc_id, seconds) by pages(doc_id).

    A rate without time or pages is null.
    """
    n = pages.groupBy("doc_id").agg(F.count("*").alias("_pages"))
    g = documents.join(n, "doc_id", "left").groupBy(*by).agg(F.count("*").alias("docs"), F.coalesce(F.sum("_pages"), F.lit(0)).alias("pages"), F.sum("seconds").alias("seconds"))
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return g.withColumns({"ms_per_page": 1000 * over("seconds", "pages"), "pages_per_second": over("pages", "seconds"), "docs_per_second": over("docs", "seconds")})
