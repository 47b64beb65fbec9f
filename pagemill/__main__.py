"""python -m pagemill parse|normalize|chunk|batch …: the pipeline from the command line."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from pagemill.functions.text_rules import apply_rules
from pagemill.operators import chunking, embedding, ledger
from pagemill.session import get_session
from pagemill.sources import loaders, sinks
from pagemill.sources.detect import detect


def parsed(spark, root: str, shard: tuple[int, int] | None = None):
    """Blocks of the files below ``root`` that have a loader, with their document's id."""
    files = loaders.scan(spark, root)
    if shard:
        files = files.filter(ledger.shard(F.col("sha256"), shard[1]) == shard[0])
    files = files.withColumn("d", detect(F.col("content"), F.col("name"))).withColumn("doc_id", loaders.document_id(F.col("sha256")))
    text = files.withColumn("text", F.make_valid_utf8(F.col("content").cast("string")))
    out = None
    for slug in loaders.BLOCK_LOADERS:
        part = text.filter(F.col("d.slug") == slug).select("doc_id", "sha256", F.explode(loaders.blocks_of(slug)("text")).alias("b")).select("doc_id", "sha256", "b.*")
        out = part if out is None else out.unionByName(part)
    return out


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="pagemill")
    p.add_argument("command", choices=["parse", "normalize", "chunk", "batch"])
    p.add_argument("root")
    p.add_argument("out")
    p.add_argument("--shard-index", type=int)
    p.add_argument("--shard-total", type=int)
    p.add_argument("--embed", action="store_true")
    a = p.parse_args(argv)
    spark = get_session()
    blocks = parsed(spark, a.root, (a.shard_index, a.shard_total) if a.shard_total else None)
    if a.command == "batch":
        manifest = f"{a.out}/manifest"
        known = sinks.read_or_empty(spark, manifest, blocks.select("sha256"))
        blocks = blocks.join(known, "sha256", "left_anti")
    if a.command != "parse":
        blocks = blocks.withColumn("text", apply_rules(F.col("text")))
    if a.command == "chunk":
        b = blocks.select("doc_id", "seq", F.concat_ws("/b", "doc_id", F.col("seq").cast("string")).alias("block_id"), "kind", F.lit(0).alias("page"), "text", F.lit("page_order").alias("source"))
        chunks = chunking.chunk(b)
        chunks.write.mode("overwrite").parquet(f"{a.out}/chunks")
        if a.embed:
            embedding.embed(spark.read.parquet(f"{a.out}/chunks").select("doc_id", "seq", "chunk_id", "text"), "text", embedding.hash_embedder).write.mode("overwrite").parquet(f"{a.out}/embeddings")
        return
    blocks.write.mode("append" if a.command == "batch" else "overwrite").parquet(f"{a.out}/blocks")
    if a.command == "batch":
        sinks.save_manifest(spark.read.parquet(f"{a.out}/blocks"), f"{a.out}/manifest")


if __name__ == "__main__":
    main()
