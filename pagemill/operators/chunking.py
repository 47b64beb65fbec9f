"""Packing ordered blocks into chunks under token budgets, with content-addressed ids and a report.

Blocks: doc_id, seq, block_id, kind, page, text, source. The order within a document is explicit (``seq``); a document is
packed by one task, since each decision depends on the one before. Documents spread over all tasks.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.sentences import force_split, split_sentences, tail_sentences, token_count, tokens


@dataclass(frozen=True)
class Budget:
    """Sizes in tokens."""

    target: int = 400
    least_band: int = 256
    soft_most: int = 768
    hard_most: int = 2048
    overlap: int = 48
    per_call: int = 16384
    texts_per_call: int = 32


CHUNKS = (
    "doc_id string, seq int, kind string, text string, source_block_ids array<string>, pages array<int>, heading_anchor string, "
    "forced_split boolean, piece_index int, overlap_of int, order_source string, ambiguous int, skipped_empty int"
)


def resolve_order(blocks: DataFrame, chain: DataFrame) -> DataFrame:
    """Blocks in reading order: doc_id, block, source.

    blocks(doc_id, page, place, block_id, …), chain(doc_id, at, block_id). A document with a chain follows it; blocks
    that it leaves out come after as orphans in page order; one without a chain goes by page. Of blocks that share an id
    the chain means the first.
    """
    first = Window.partitionBy("doc_id", "block_id").orderBy("page", "place")
    numbered = blocks.withColumn("_copy", F.row_number().over(first))
    has = chain.select("doc_id").distinct().withColumn("_chain", F.lit(True))
    one = numbered.filter(F.col("_copy") == 1)
    rank = lambda *c: F.row_number().over(Window.partitionBy("doc_id").orderBy(*c)) - 1
    told = chain.join(one, ["doc_id", "block_id"]).withColumn("source", F.lit("reading_order")).withColumn("_k", F.struct(F.lit(0).alias("g"), F.col("at").cast("long").alias("x"), F.lit(0).cast("long").alias("y"))).drop("at")
    order = F.struct(F.lit(1).alias("g"), F.col("page").cast("long").alias("x"), F.col("place").cast("long").alias("y"))
    orphan = one.join(has, "doc_id").join(chain.select("doc_id", "block_id").distinct(), ["doc_id", "block_id"], "left_anti").drop("_chain").withColumn("source", F.lit("orphan")).withColumn("_k", order)
    paged = numbered.join(has, "doc_id", "left_anti").withColumn("source", F.lit("page_order")).withColumn("_k", order)
    every = told.unionByName(orphan).unionByName(paged)
    return every.withColumn("seq", rank("_k")).drop("_k", "_copy")


def pack(blocks: list[tuple], budget: Budget = Budget()) -> list[dict]:
    """The chunks of one document's ordered blocks (block_id, kind, page, text, source)."""
    out: list[dict] = []
    anchor, open_, size, seam = "", [], 0, None
    skipped = ambiguous = 0

    def emit(parts: list[str], of: list[tuple], forced: bool = False, piece: int | None = None) -> None:
        kinds = {b[1] for b in of}
        out.append({
            "seq": len(out), "kind": of[0][1] if len(kinds) == 1 else "mixed", "text": "\n".join(parts), "source_block_ids": [b[0] for b in of],
            "pages": sorted({b[2] for b in of}), "heading_anchor": anchor, "forced_split": forced, "piece_index": piece, "overlap_of": None, "order_source": of[0][4],
        })

    def close() -> None:
        nonlocal open_, size, seam
        if open_:
            emit([b[3] for b in open_], open_)
            if seam:
                out[-1]["text"] = seam + "\n" + out[-1]["text"]
                out[-1]["overlap_of"] = len(out) - 2
        open_, size, seam = [], 0, None

    for block in blocks:
        text = block[3] or ""
        if not text.strip():
            skipped += 1
            continue
        if tokens(text) > budget.hard_most:
            close()
            found, held = split_sentences(text)
            ambiguous += held
            pieces: list[tuple[list[str], bool]] = []
            held_parts: list[str] = []
            for s in found:
                if tokens(s) > budget.hard_most:
                    pieces += [(held_parts, False)] if held_parts else []
                    held_parts = []
                    pieces += [([p], True) for p in force_split(s, budget.hard_most)]
                elif held_parts and tokens("\n".join([*held_parts, s])) > budget.target:
                    pieces.append((held_parts, False))
                    held_parts = [s]
                else:
                    held_parts = [*held_parts, s]
            pieces += [(held_parts, False)] if held_parts else []
            for k, (parts, forced) in enumerate(pieces):
                emit(parts, [block], forced, k)
        elif block[1] == "heading":
            close()
            anchor = block[3]
            if out and out[-1]["text"]:
                seam = "\n".join(tail_sentences(out[-1]["text"], budget.overlap)) or None
            open_, size = [block], len(text)
        elif not open_:
            open_, size = [block], len(text)
        else:
            joined = size + 1 + len(text)  # characters add up, tokens do not
            if max(1, joined // 4) <= budget.target or (max(1, size // 4) < budget.least_band and max(1, joined // 4) <= budget.soft_most):
                open_, size = [*open_, block], joined
            else:
                close()
                open_, size = [block], len(text)
    close()
    for c in out:
        c["ambiguous"], c["skipped_empty"] = ambiguous, skipped
    return out


def chunk_id(doc_id: Column, text: Column, ids: Column, piece: Column) -> Column:
    """sha256 of canonical JSON; a null piece index is left out."""
    return F.sha2(F.to_json(F.struct(doc_id.alias("doc_id"), piece.alias("piece_index"), ids.alias("source_block_ids"), text.alias("text"))), 256)


def chunk(blocks: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """blocks(doc_id, seq, block_id, kind, page, text, source) -> chunks with ids, token and character counts."""
    one = F.struct("seq", "block_id", "kind", "page", "text", "source")
    docs = blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("blocks"))
    rest = CHUNKS.removeprefix("doc_id string, ")

    @F.pandas_udf(f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in rest.split(', '))}>>")
    def packed(column: pd.Series) -> pd.Series:
        return column.map(lambda bs: pack([(b["block_id"], b["kind"], b["page"], b["text"], b["source"]) for b in bs], budget))

    out = docs.select("doc_id", F.explode(packed("blocks")).alias("c")).select("doc_id", "c.*")
    out = out.withColumns({"chunk_id": chunk_id(F.col("doc_id"), F.col("text"), F.col("source_block_ids"), F.col("piece_index")), "token_count": token_count(F.col("text")), "char_count": F.length("text"), "page": F.coalesce(F.array_min("pages"), F.lit(0))})
    before = Window.partitionBy("doc_id").orderBy("seq")
    return out.withColumn("overlap_source_chunk_id", F.when(F.col("overlap_of").isNotNull(), F.lag("chunk_id").over(before))).drop("overlap_of")


def report(chunks: DataFrame) -> DataFrame:
    """Per document: chunks, forced splits, overlaps, tokens, ambiguous boundaries, skipped blocks."""
    return chunks.groupBy("doc_id").agg(
        F.count("*").alias("chunks_created"), F.sum(F.col("forced_split").cast("long")).alias("forced_splits"),
        F.count("overlap_source_chunk_id").alias("overlap_chunks"), F.sum("token_count").cast("long").alias("tokens_total"),
        F.max("ambiguous").alias("split_ambiguous"), F.max("skipped_empty").alias("blocks_skipped_empty"),
    )


def group_by_budget(rows: DataFrame, key: str, order: str, size: str, budget: Budget = Budget()) -> DataFrame:
    """Consecutive rows of a key in calls of at most per_call tokens and texts_per_call rows; a larger row is alone.

    Greedy with a reset at each cut, so it is a fold over the ordered array, in the JVM.
    """
    item = F.struct(F.col(order).alias("o"), F.col(size).cast("long").alias("n"))
    zero = F.struct(F.lit(-1).alias("g"), F.lit(0).cast("long").alias("t"), F.lit(0).alias("c"), F.array().cast("array<struct<o:bigint,n:bigint,g:int>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        cut = (a.g < 0) | (a.t + x.n > budget.per_call) | (a.c >= budget.texts_per_call)
        g = F.when(cut, a.g + 1).otherwise(a.g)
        return F.struct(g.alias("g"), F.when(cut, x.n).otherwise(a.t + x.n).alias("t"), F.when(cut, F.lit(1)).otherwise(a.c + 1).alias("c"), F.concat(a["out"], F.array(F.struct(x.o.cast("long").alias("o"), x.n.alias("n"), g.alias("g")))).alias("out"))

    grouped = rows.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("xs"))
    flat = grouped.select(key, F.explode(F.aggregate("xs", zero, step)["out"]).alias("x"))
    return flat.select(key, F.col("x.o").alias(order), F.col("x.n").alias(size), F.col("x.g").alias("call"))


def snapshot(budget: Budget) -> dict:
    return asdict(budget)
