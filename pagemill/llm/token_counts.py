"""Token counts without token ids: pieces per distinct pre-token, joined to the documents' pre-token frequencies, summed.

Texts are taken in blocks of about a megabyte. A block's distinct pre-tokens are grouped (and compared by their bytes), each
is counted once, and the table (document, pre-token, frequency) is joined to those counts and summed by document.

Defined results: a null text counts as the empty text (0 bytes, 0 tokens); a null doc_id is returned as null;
repeated rows are counted each; other columns are ignored.

Scale: one pass over doc_id and text, no shuffle. A worker holds a bounded dictionary of pre-tokens; the table of
all distinct pre-tokens, which grows with the corpus, is never built, sent or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import text_of
from pagemill.llm.pretokens import PieceCounts, held
from pagemill.llm.textvec import blocks


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document, by the byte-level BPE in the file ``tokenizer``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(PieceCounts, tokenizer)
        for batch in batches:
            tokens = [known.counts(b) for b in blocks(batch.column("text"))]
            n_bytes = [b.ends - b.starts for b in blocks(batch.column("text"))]
            both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n_bytes, tokens)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, both)], ["doc_id", "n_bytes", "n_tokens"])

    return text_of(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")


def over_limit(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """Contract of op2."""
    return token_counts(docs, tokenizer).withColumn("over_limit", F.col("n_tokens") > limit)
