"""Near-duplicate documents: bottom-k sketches of one hash function propose, union sketches filter, whole sets decide.

1. A document's distinct shingles are hashed once; the ``SKETCH`` smallest hashes are its sketch, and sums over all of
   them (128 bits, and their number) name its set. Documents with equal sets are one class, linked with no more ado.
2. Inverted lists hold, for each retained hash, the classes that retain it. Two classes at the similarity share at least
   ``overlap(size)`` retained hashes (but for a chance of ``MISS``). So each class looks only at its rarest lists, so many
   that two such classes meet in ``meetings(size)`` of them. In lists of up to ``HOT`` classes they are paired and the
   overlaps counted. Longer lists make no pairs: their classes of like size are tied through the smallest one, which
   brings them into one group with no list of pairs. Both ways hold every pair that the sketches can show.
3. Components of candidates bound where links can be. Within one, whole sets are compared: an estimate from the union
   of two sketches rules pairs out (again at ``MISS``), exact intersections decide the rest, and pairs that links
   already connect are skipped. A component of more than ``BLOCK`` classes or ``BLOCK_BYTES`` of text is dealt over
   tasks in blocks by size: all its members are held against its most central ones first, and whoever they do not
   bring together is then held against the blocks whose sizes allow the similarity.
4. Components of the links that were confirmed give the result.

Defined results: a null or empty text, or one without words, has no shingles and no links; a text of fewer words than
a shingle has one shingle, the whole sequence; rows that share a doc_id are one node with the links of each; a null
doc_id is linked with nothing, its component is null and it is kept; other columns are ignored, in ``drop_near``
passed through whatever their names. An empty table gives no rows. Shingles are 64-bit hashes that mix every byte of
their words; unequal ones collide with a chance of 2 ** -64.

Scale: texts are read twice; those of candidates are shuffled once (for step 3); the rest moves ``SKETCH`` hashes a class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.common import forget, fresh, stage, text_of
from pagemill.llm.graph import components
from pagemill.llm.textvec import U64, blocks, mix, shingles, word_hashes, words

#: Retained hashes; classes of a list that are paired; classes and bytes of text that one task compares; members tried first.
SKETCH, HOT, BLOCK, BLOCK_BYTES, CENTRES = 64, 32, 400, 8 << 20, 16
#: Members of a long list that are tied together at once.
TIED = 512
#: Chance that a pair right at the similarity is not proposed, and again that it is not compared.
MISS = 1e-9


@cache
def least_shared(drawn: int, threshold: int) -> int:
    """How many of ``drawn`` hashes of a union two sets at ``threshold`` percent share, but for a chance of ``MISS``."""
    p, tail = threshold / 100, 0.0
    for m in range(drawn + 1):
        tail += math.comb(drawn, m) * p**m * (1 - p) ** (drawn - m)
        if tail > MISS:
            return m
    return drawn


def overlap(size: int, threshold: int) -> int:
    """Retained hashes that a sketch of ``size`` shares with that of any set at the similarity."""
    if 100 * size <= threshold * SKETCH:  # the union has at most SKETCH hashes, so both sketches are whole sets
        return -(-threshold * size // 100)
    return max(1, least_shared(size, threshold))


def meetings(size: int, threshold: int) -> int:
    return max(1, overlap(size, threshold) // 8)


def _by_size(size: Column, value) -> Column:
    return F.element_at(F.array(*[F.lit(int(value(k))) for k in range(1, SKETCH + 1)]), size)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    for b in blocks(column):
        w = words(b)
        g, _, lo, hi = shingles(word_hashes(b, w, fold=True), w, width)
        for s, e in zip(lo.tolist(), hi.tolist(), strict=True):
            x = np.sort(g[s:e])
            yield x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, bytes, n (shingles), two sums that name the set, and the sketch."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, kept = [], [], [], []
            with np.errstate(over="ignore"):
                for x in shingle_sets(batch.column("text"), width):
                    n.append(len(x))
                    one.append(int(x.sum(dtype=U64).view(np.int64)))
                    two.append(int(mix(x ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64).view(np.int64)))
                    kept.append(x[:SKETCH].view(np.int64))
            size = pc.cast(pc.binary_length(batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, *(pa.array(x, pa.int64()) for x in (n, one, two)), pa.array(kept, pa.list_(pa.int64()))], ["doc_id", "bytes", "n", "one", "two", "sketch"])

    return text_of(docs).mapInArrow(make, "doc_id long, bytes long, n long, one long, two long, sketch array<long>")


def candidates(classes: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(edges a, b between classes that may be linked; a staged table rep, common: how common a class's hashes are)."""
    kept = classes.select("rep", "one", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
    lists = kept.groupBy("v").agg(F.count("*").alias("members")).filter(F.col("members") > 1)
    met = kept.join(lists, "v").groupBy("rep", "one", "n", "size").agg(F.sort_array(F.collect_list(F.struct("members", "v"))).alias("lists"), F.sum("members").alias("common"))
    # of a sketch's rarest size - overlap + meetings lists, those with nobody else come first and are not in ``lists``
    wide = _by_size(F.col("size"), lambda k: k - overlap(k, threshold) + meetings(k, threshold)) - (F.col("size") - F.size("lists"))
    met = met.withColumn("lists", F.slice("lists", F.lit(1), F.greatest(F.lit(0), wide)))
    met = stage(met.withColumn("meet", _by_size(F.col("size"), lambda k: meetings(k, threshold))), "shared-hashes")
    each = met.select("rep", "n", "meet", F.explode("lists").alias("l")).select("rep", "n", "meet", "l.members", "l.v")

    cold = each.filter(F.col("members") <= HOT).select("v", "rep", "n", "meet")
    other = cold.select("v", F.col("rep").alias("rep_b"), F.col("n").alias("n_b"), F.col("meet").alias("meet_b"))
    like = 100 * F.least("n", "n_b") >= threshold * F.greatest("n", "n_b")
    pairs = cold.join(other, "v").filter((F.col("rep") < F.col("rep_b")) & like)
    pairs = pairs.groupBy("rep", "rep_b").agg(F.count("*").alias("shared"), F.min(F.least("meet", "meet_b")).alias("meet")).filter(F.col("shared") >= F.col("meet"))
    edges = pairs.select(F.col("rep").alias("a"), F.col("rep_b").alias("b"))

    # size classes of the square root of the allowed ratio: like sizes lie in one or in neighbouring ones
    step = -math.log(threshold / 100) * (1 + 1e-9) if threshold < 100 else 0.5
    # a list falls into parts of about TIED members: each is tied to the smallest of its part and size class, those to the
    # smallest of two neighbouring size classes
    parts = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("members") / F.lit(float(TIED)))))).cast("long")
    band = F.floor(F.log(F.col("n").cast("double")) / step)
    hot = each.filter(F.col("members") > HOT).select("rep", "v", F.pmod(F.xxhash64("rep"), parts).alias("part"), band.alias("band"))

    def tied(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(F.min("rep").alias("least"), F.collect_list("rep").alias("all"))

    in_parts = tied(hot, ["v", "band", "part"])
    over_parts = in_parts.select("v", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.col("least").alias("rep"))
    ties = in_parts.select("least", "all").unionByName(tied(over_parts, ["v", "band"]).select("least", "all"))
    ties = ties.filter(F.size("all") > 1).select(F.explode("all").alias("a"), F.col("least").alias("b")).filter(F.col("a") != F.col("b"))
    return edges.unionByName(ties).distinct(), met


def _links(query: list[np.ndarray], member: list[np.ndarray], q_id: list[int], m_id: list[int], threshold: int) -> list[tuple[int, int]]:
    """Links that connect all that are connected by a pair of query and member at ``threshold`` percent."""
    root: dict[int, int] = {x: x for x in (*q_id, *m_id)}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    needed = np.array([least_shared(k, threshold) for k in range(2 * SKETCH + 1)])
    size = np.array([len(x) for x in member])
    flat = np.concatenate([x[:SKETCH] for x in member]) if member else np.zeros(0, U64)
    of = np.repeat(np.arange(len(member)), np.minimum(size, SKETCH))
    top = np.array([x[min(len(x), SKETCH) - 1] if len(x) else 0 for x in member], U64)
    order = np.argsort(flat, kind="stable")
    flat_sorted, of_sorted = flat[order], of[order]
    whole: tuple[np.ndarray, np.ndarray] | None = None
    for x, a in zip(query, q_id, strict=True):
        fit = (100 * np.minimum(size, len(x)) >= threshold * np.maximum(size, len(x))) & (size > 0)
        if not fit.any() or not len(x):
            continue
        s = x[:SKETCH]
        lo, hi = np.searchsorted(flat_sorted, s), np.searchsorted(flat_sorted, s, "right")
        hits = np.concatenate([of_sorted[i:j] for i, j in zip(lo.tolist(), hi.tolist(), strict=True)])
        both = np.bincount(hits, minlength=len(member)).astype(float)
        # of the union's hashes up to where both sketches reach, the share that both have
        limit = np.minimum(top, s[-1] if len(x) > SKETCH else U64(0xFFFFFFFFFFFFFFFF))
        limit = np.where(size > SKETCH, limit, s[-1] if len(x) > SKETCH else U64(0xFFFFFFFFFFFFFFFF))
        mine = np.searchsorted(s, limit, "right")
        theirs = np.bincount(of, flat <= limit[of], len(member))
        union = (mine + theirs - both).astype(np.int64)
        near = np.flatnonzero(fit & (both >= needed[union]))
        near = near[np.argsort(-(both / np.maximum(1, union))[near], kind="stable")]
        near = [j for j in near.tolist() if m_id[j] != a and find(m_id[j]) != find(a)]
        if len(near) > 8:  # many at once: count intersections over one sorted array of all members
            if whole is None:
                everything = np.concatenate(member)
                owner = np.repeat(np.arange(len(member)), size)
                o = np.argsort(everything, kind="stable")
                whole = everything[o], owner[o]
            lo, hi = np.searchsorted(whole[0], x), np.searchsorted(whole[0], x, "right")
            span = hi - lo
            pick = np.repeat(lo - np.cumsum(span) + span, span) + np.arange(span.sum())
            common = np.bincount(whole[1][pick], minlength=len(member))
        else:
            common = {j: len(np.intersect1d(x, member[j], assume_unique=True)) for j in near}
        for j in near:
            b, c = m_id[j], int(common[j])
            if 100 * c >= threshold * (len(x) + len(member[j]) - c) and find(a) != find(b):
                out.append((a, b))
                root[find(a)] = find(b)
    return out


def _confirm(rows: DataFrame, width: int, threshold: int) -> DataFrame:
    """rows(group, asks, tells, rep, text) -> links a, b; in a group all that ask are held against all that tell."""

    def group(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        sets = list(shingle_sets(table.column("text"), width))
        ids, asks, tells = (table.column(c).to_pylist() for c in ("rep", "asks", "tells"))
        q, m = [i for i, x in enumerate(asks) if x], [i for i, x in enumerate(tells) if x]
        found = _links([sets[i] for i in q], [sets[i] for i in m], [ids[i] for i in q], [ids[i] for i in m], threshold)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return rows.select("group", "asks", "tells", "rep", "text").groupBy("group").applyInArrow(group, "a long, b long")


def confirmed(docs: DataFrame, classes: DataFrame, threshold: int, width: int) -> list[DataFrame]:
    """Staged tables of links a, b between classes, confirmed on whole sets; as many as connect what is connected."""
    edges, met = candidates(classes, threshold)
    member = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("of"))
    # like sizes lie in one band or in neighbouring ones
    step = -math.log(threshold / 100) * (1 + 1e-9) if threshold < 100 else 1.0
    member = member.join(classes.select("rep", "bytes", F.floor(F.log(F.col("n").cast("double")) / step).alias("band")), "rep")
    too_many = (F.col("size") > BLOCK) | (F.col("held") > BLOCK_BYTES)
    sized = stage(member.join(member.groupBy("of").agg(F.count("*").alias("size"), F.sum("bytes").alias("held")), "of").withColumn("large", too_many), "candidates")
    # a merge join at every size: the members grow with the corpus and are not broadcast
    texts = sized.select("rep", "of", "band", "large").hint("merge").join(text_of(docs).filter(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "rep"), "rep")
    # with ids that repeat, all their texts stand for the node
    texts = stage(texts.select("rep", "of", "band", "large", "text"), "candidate-texts")
    yes, no = F.lit(True), F.lit(False)
    small = texts.filter(~F.col("large")).select(F.col("of").cast("string").alias("group"), yes.alias("asks"), yes.alias("tells"), "rep", "text")
    of_large = sized.filter("large")
    if not of_large.limit(1).count():
        links = stage(_confirm(small, width, threshold), "links")
        for t in (met, sized, texts):
            forget(t)
        return [links]

    large = texts.filter("large")
    blocks_of = F.greatest(F.ceil(F.count("*") / F.lit(float(BLOCK))), F.ceil(F.sum("bytes") / F.lit(float(BLOCK_BYTES)))).cast("int")
    cells = stage(of_large.groupBy("of", "band").agg(blocks_of.alias("blocks")), "candidate-blocks")
    name = F.concat_ws("/", F.col("of").cast("string"), F.col("band").cast("string"), F.col("at").cast("string"))
    told = large.join(cells, ["of", "band"]).withColumn("at", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    told = told.select(name.alias("group"), no.alias("asks"), yes.alias("tells"), "rep", "text")

    def everywhere(who: DataFrame) -> DataFrame:
        near = who.select("of", "rep", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"), "text")
        near = near.join(cells, ["of", "band"]).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return near.select(name.alias("group"), yes.alias("asks"), no.alias("tells"), "rep", "text")

    rank = F.row_number().over(Window.partitionBy("of").orderBy(F.desc("common"), "rep"))
    # the few most central per hash bucket first, so that no window holds a whole component
    spread = F.row_number().over(Window.partitionBy("of", F.pmod(F.xxhash64("rep"), F.lit(64))).orderBy(F.desc("common"), "rep"))
    centre = of_large.join(met.select("rep", "common"), "rep").withColumn("k", spread).filter(F.col("k") <= CENTRES).withColumn("k", rank).filter(F.col("k") <= CENTRES)
    first = stage(_confirm(small.unionByName(told).unionByName(everywhere(large.join(centre.select("rep"), "rep", "left_semi"))), width, threshold), "links-centres")

    joined = components(first.join(of_large.select(F.col("rep").alias("a")), "a", "left_semi")).withColumnRenamed("node", "rep")
    part = of_large.select("rep", "of").join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    parts = part.groupBy("of", "component").agg(F.count("*").alias("members"))
    main = parts.groupBy("of").agg(F.max_by("component", F.struct("members", "component")).alias("main"))
    left = stage(part.join(main, "of").filter(F.col("component") != F.col("main")).select("rep"), "unplaced")
    second = stage(_confirm(told.unionByName(everywhere(large.join(left, "rep", "left_semi"))), width, threshold), "links-rest")
    for t in (met, sized, texts, cells, left):
        forget(t)
    return [first, second]


def near_components(docs: DataFrame, *, threshold: int = 80, width: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row: links are Jaccard similarities of ``threshold`` percent."""
    found = stage(sketches(docs, width), "sketches")
    usable = found.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = usable.groupBy("one", "two", "n").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.max("bytes").alias("bytes"), F.count("*").alias("copies"))
    classes = stage(classes, "classes")
    links = confirmed(docs, classes, threshold, width)
    # an id with two texts links their classes
    twice = usable.groupBy("doc_id").agg(F.count("*").alias("rows")).filter(F.col("rows") > 1).select("doc_id")
    same = usable.join(twice, "doc_id").join(classes.select("one", "two", "n", "rep"), ["one", "two", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comp = stage(components(reduce(DataFrame.unionByName, [same, *links])), "components")
    for t in links:
        forget(t)
    # only sets with copies or links change anything
    of_class = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").filter(F.col("component").isNotNull() | (F.col("copies") > 1))
    of_class = of_class.select("one", "two", "n", F.coalesce("component", "rep").alias("component"))
    tied = usable.select("doc_id", "one", "two", "n").join(of_class, ["one", "two", "n"], "left").select("doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
    # rows without an id or a set are alone, and meet nobody in a join
    alone = found.filter(F.col("doc_id").isNull() | (F.col("n") == 0)).select("doc_id", "n", F.col("doc_id").alias("component"))
    out = tied.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near(docs: DataFrame, *, threshold: int = 80, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that stand for their group, and those that belong to none."""
    (name,) = fresh(docs, "gone")
    gone = near_components(docs, threshold=threshold, width=width).filter(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")
