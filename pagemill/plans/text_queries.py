"""Queries over texts: blocks, normalization, types, tokens, chunks, sentences, hashes, repetition, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.functions import text_rules
from pagemill.functions.sentences import sentences, token_count
from pagemill.operators import analytics, chunking, documents, embedding, ledger, references, tables
from pagemill.session import table
from pagemill.sources import detect, loaders

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


LINES = """lines AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS seq, trim(xs[i], chr(32) || chr(9) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)) AS text
FROM (SELECT doc_id, string_split(text, chr(10)) AS xs FROM documents), unnest(range(1, len(xs) + 1)) AS t(i))"""


@query(f"WITH {LINES} SELECT doc_id, seq, text FROM lines WHERE text <> ''")
def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.text_blocks(table(spark, sf_dir, "documents"))


# string columns before and after, without look-around: after the split a lone line break is any line break
NORMALIZED = r"""norm AS (SELECT doc_id, seq, text AS raw,
  trim(regexp_replace(translate(regexp_replace(nfc_normalize(text), '(\S)—(\S)', '\1 - \2', 'g'), '‘’‚‛“”„‟«»–‒―—', '''''''''""""""----'), '[ \t]{2,}', ' ', 'g')) AS text
  FROM lines WHERE text <> '')"""


@query(f"WITH {LINES}, {NORMALIZED} SELECT doc_id, seq, text FROM norm")
def normalized_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = documents.text_blocks(table(spark, sf_dir, "documents"))
    return b.withColumn("text", text_rules.apply_rules(F.col("text")))


@query(f"""WITH {LINES}, {NORMALIZED} SELECT doc_id, count(*) AS seen, sum((text <> raw)::INT)::BIGINT AS changed,
  sum(length(raw))::BIGINT AS chars_in, sum(length(text))::BIGINT AS chars_out FROM norm GROUP BY doc_id""")
def normalization_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = documents.text_blocks(table(spark, sf_dir, "documents")).withColumn("raw", F.col("text"))
    t = text_rules.traced(b, "text")
    return t.groupBy("doc_id").agg(F.count("*").alias("seen"), F.sum((F.size("changed") > 0).cast("long")).alias("changed"), F.sum(F.length("raw")).alias("chars_in"), F.sum(F.length("text")).alias("chars_out"))


@query(f"""WITH {LINES}, {NORMALIZED} SELECT r.rule, coalesce(sum(r.n), 0)::BIGINT AS changed FROM (
  SELECT 'typography' AS rule, (text <> raw AND regexp_matches(raw, '[‘’‚‛“”„‟«»–‒―—]'))::INT AS n FROM norm
  UNION ALL SELECT 'collapse_whitespace', (regexp_matches(raw, '[ \\t]{{2,}}'))::INT FROM norm
  UNION ALL SELECT 'unicode', (nfc_normalize(raw) <> raw)::INT FROM norm) r GROUP BY r.rule""".replace("\\\\", "\\"))
def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many blocks each of three rules changed, zeros included."""
    b = text_rules.traced(documents.text_blocks(table(spark, sf_dir, "documents")), "text")
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.array_contains("changed", r).cast("long").alias("n")) for r in ("typography", "collapse_whitespace", "unicode")]))
    return b.select(each.alias("r")).groupBy("r.rule").agg(F.sum("r.n").alias("changed"))


@query("""SELECT doc_id, slug, confidence, CASE slug WHEN 'xml' THEN 'application/xml' WHEN 'html' THEN 'text/html' WHEN 'json' THEN 'application/json' WHEN 'markdown' THEN 'text/markdown'
  WHEN 'tsv' THEN 'text/tab-separated-values' WHEN 'csv' THEN 'text/csv' WHEN 'unknown' THEN 'application/octet-stream' ELSE 'text/plain' END AS mime FROM (
  SELECT doc_id, s.slug AS slug, s.confidence AS confidence FROM (SELECT doc_id, CASE
    WHEN text = '' THEN {'slug': 'unknown', 'confidence': 0.0::DOUBLE}
    WHEN starts_with(ltrim(text), '<?xml') THEN {'slug': 'xml', 'confidence': 0.92::DOUBLE}
    WHEN regexp_matches(lower(substr(ltrim(text), 1, 256)), '^(<!doctype|<html|<head)') THEN {'slug': 'html', 'confidence': 0.95::DOUBLE}
    WHEN json_valid(text) AND strlen(text) <= 8192 THEN {'slug': 'json', 'confidence': 0.97::DOUBLE}
    WHEN regexp_matches(ltrim(text), '^(# |## |### |```|\\* |- )') THEN {'slug': 'markdown', 'confidence': 0.8::DOUBLE}
    WHEN len(tabs) > 0 AND list_min(tabs) = list_max(tabs) AND list_min(tabs) > 0 THEN {'slug': 'tsv', 'confidence': 0.9::DOUBLE}
    WHEN len(commas) > 0 AND list_min(commas) = list_max(commas) AND list_min(commas) > 0 THEN {'slug': 'csv', 'confidence': 0.88::DOUBLE}
    ELSE {'slug': 'plaintext', 'confidence': 0.55::DOUBLE} END AS s
  FROM (SELECT doc_id, text, list_transform(ls, lambda x: length(x) - length(replace(x, chr(9), ''))) AS tabs, list_transform(ls, lambda x: length(x) - length(replace(x, ',', ''))) AS commas
    FROM (SELECT doc_id, text, list_filter(string_split(decode(encode(text)[1:8192]::BLOB), chr(10)), lambda x: trim(x) <> '')[1:12] AS ls
      FROM (SELECT doc_id, text FROM documents)))))""".replace("decode(encode(text)[1:8192]::BLOB)", "text").replace("\\\\", "\\"))
def document_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as files; delimiters are counted in the first twelve lines, wherever the head ends."""
    d = table(spark, sf_dir, "documents").select("doc_id", detect.detect(F.encode("text", "UTF-8"), F.lit("a.txt"), whole=True).alias("d"))
    return d.select("doc_id", "d.slug", "d.confidence", "d.mime")


@query("""SELECT page_id, CASE WHEN regexp_matches(lower(substr(ltrim(html), 1, 256)), '^(<!doctype|<html|<head)') THEN 'html' ELSE 'other' END AS kind,
  lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '\\.([^.]*)$', 1)) AS declared FROM pages""".replace("\\\\", "\\"))
def page_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "pages").select("page_id", detect.detect(F.encode("html", "UTF-8"), F.col("url")).alias("d"))
    return d.select("page_id", F.when(F.col("d.slug") == "html", "html").otherwise("other").alias("kind"), F.col("d.declared").alias("declared"))


@query("SELECT lang, count(*) AS n_docs, sum(greatest(1, length(text) // 4))::BIGINT AS tokens, max(greatest(1, length(text) // 4))::INTEGER AS longest FROM documents GROUP BY lang")
def char4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = token_count(F.col("text"))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum(n).alias("tokens"), F.max(n).alias("longest"))


@query("""WITH RECURSIVE o AS (SELECT source, doc_id, greatest(1, length(text) // 4) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
g AS (SELECT source, doc_id, n, r, 0 AS call, n AS t, 1 AS c FROM o WHERE r = 1
  UNION ALL SELECT o.source, o.doc_id, o.n, o.r, CASE WHEN g.t + o.n > 16384 OR g.c >= 32 THEN g.call + 1 ELSE g.call END,
    CASE WHEN g.t + o.n > 16384 OR g.c >= 32 THEN o.n ELSE g.t + o.n END, CASE WHEN g.t + o.n > 16384 OR g.c >= 32 THEN 1 ELSE g.c + 1 END
  FROM g JOIN o ON o.source = g.source AND o.r = g.r + 1)
SELECT source, doc_id, n::BIGINT AS tokens, call::INTEGER AS call FROM g""")
def token_budget_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id", token_count(F.col("text")).alias("tokens"))
    return chunking.group_by_budget(d, "source", "doc_id", "tokens")


@query("SELECT doc_id, sha256('{\"doc_id\":\"d-' || doc_id || '\",\"source_block_ids\":[\"d-' || doc_id || '/b00_0000\"],\"text\":' || to_json(text)::VARCHAR || '}') AS chunk_id FROM documents")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("d-"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", chunking.chunk_id(name, F.col("text"), F.array(F.concat(name, F.lit("/b00_0000"))), F.lit(None).cast("int")).alias("chunk_id"))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = documents.text_blocks(table(spark, sf_dir, "documents")).withColumn("text", text_rules.apply_rules(F.col("text")))
    doc = F.concat(F.lit("d-"), F.col("doc_id").cast("string"))
    kind = F.when(F.length("text") < 20, "heading").otherwise("paragraph")
    return b.select(doc.alias("doc_id"), "seq", F.concat(doc, F.lit("/b00_"), F.lpad(F.col("seq").cast("string"), 4, "0")).alias("block_id"), kind.alias("kind"), F.lit(0).alias("page"), "text", F.lit("page_order").alias("source"))


@query()
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of under twenty characters stand for headings."""
    c = chunking.chunk(_blocks(spark, sf_dir))
    return c.select("doc_id", "seq", "chunk_id", "kind", "token_count", "char_count", "heading_anchor", "forced_split", "overlap_source_chunk_id", F.size("source_block_ids").alias("n_blocks"))


@query()
def chunk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = chunking.report(chunking.chunk(_blocks(spark, sf_dir)))
    lang = table(spark, sf_dir, "documents").select(F.concat(F.lit("d-"), F.col("doc_id").cast("string")).alias("doc_id"), "lang")
    sums = [F.sum(c).alias(c) for c in ("chunks_created", "forced_splits", "overlap_chunks", "tokens_total", "blocks_skipped_empty")]
    return r.join(lang, "doc_id").groupBy("lang").agg(F.count("*").alias("n_docs"), *sums)


@query(f"WITH {LINES} SELECT doc_id, seq, text, coalesce(last_value(CASE WHEN length(text) < 20 THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS anchor FROM lines WHERE text <> ''")
def heading_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = documents.text_blocks(table(spark, sf_dir, "documents")).withColumn("kind", F.when(F.length("text") < 20, "heading").otherwise("paragraph"))
    return documents.heading_anchor(b).drop("kind")


@query()
def sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "documents").select("doc_id", sentences("text").alias("s"))
    return s.select("doc_id", F.size("s.sentences").alias("n_sentences"), F.col("s.ambiguous").alias("ambiguous"))


@query()
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.explode(loaders.blocks_of("html")("html")).alias("b"))
    return p.select("page_id", "b.seq", "b.kind", "b.text")


@query()
def markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "documents").select("doc_id", F.explode(loaders.blocks_of("markdown")("text")).alias("b"))
    return p.groupBy("doc_id", "b.kind").agg(F.count("*").alias("n"), F.sum(F.length("b.text")).alias("chars"))


@query("""SELECT event_id, '{"k": ' || (props::JSON->>'k') || '}' AS code FROM events""")
def json_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "events").select("event_id", F.explode(loaders.blocks_of("json")("props")).alias("b"))
    return p.select("event_id", F.col("b.text").alias("code"))


@query("""SELECT n_nationkey, n_name AS name_cell, n_regionkey::VARCHAR AS region_cell FROM nation""")
def csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation table written as one CSV text a row and read back as a table of cells."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("name,region\n"), F.col("n_name"), F.lit(","), F.col("n_regionkey").cast("string"), F.lit("\n \n")).alias("csv"))
    t = n.select("n_nationkey", F.explode(loaders.tables_of(",")("csv")).alias("t"))
    return t.select("n_nationkey", F.col("t.rows")[0][0].alias("name_cell"), F.col("t.rows")[0][1].alias("region_cell"))


HASHES = "h AS (SELECT doc_id, sha256(trim(regexp_replace(text, '[\\s\\x{85}\\x{a0}]+', ' ', 'g'))) AS text_hash FROM documents)"


@query(f"WITH {HASHES} SELECT doc_id, text_hash, min(doc_id) OVER w AS first_doc, count(*) OVER w AS copies, row_number() OVER (PARTITION BY text_hash ORDER BY doc_id) > 1 AS is_duplicate FROM h WINDOW w AS (PARTITION BY text_hash)")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.exact_duplicates(table(spark, sf_dir, "documents"))


@query("""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}\\p{M}_]+') AS w FROM documents),
g AS (SELECT doc_id, list_slice(w, i, i + 3) AS g FROM w, unnest(range(1, len(w) - 2)) AS t(i) WHERE len(w) >= 50),
c AS (SELECT doc_id, g, count(*) AS c FROM g GROUP BY ALL), s AS (SELECT doc_id, sum(c) AS grams, sum(CASE WHEN c > 1 THEN c - 1 ELSE 0 END) AS surplus FROM c GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::INTEGER AS n_words, coalesce(surplus / grams, 0.0)::DOUBLE AS repetition, coalesce(surplus / grams, 0.0) > 0.25 AS suspicious FROM w LEFT JOIN s USING (doc_id)""")
def repetition_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.repetition(table(spark, sf_dir, "documents"))


@query("""WITH w AS (SELECT item_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}\\p{M}_]+') AS w FROM benchmark),
g AS (SELECT DISTINCT id, list_slice(w, i, i + 1) AS g FROM w, unnest(range(1, len(w))) AS t(i)), n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
p AS (SELECT a.id, b.id AS id_b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.id < b.id GROUP BY ALL)
SELECT p.id, p.id_b, p.c / (x.n + y.n - p.c) AS jaccard FROM p JOIN n x ON x.id = p.id JOIN n y ON y.id = p.id_b WHERE p.c / (x.n + y.n - p.c) >= 0.01 ORDER BY jaccard DESC, p.id, p.id_b LIMIT 40""")
def similar_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forty most similar benchmark items by shared word pairs; a top-k report."""
    u = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.array_distinct(analytics.ngrams(analytics.words_of(F.col("text")), 2)).alias("grams"))
    return analytics.similar_pairs(u, 0.01)


@query()
def near_dup_trigram_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forty most similar pairs of documents by shared three-word grams, from 0.4 on; a top-k report."""
    # words first, else each gram would split its text again; the operator makes grams distinct, by their hashes
    w = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), analytics.words_of(F.col("text")).alias("w"))
    return analytics.similar_sets(w.select("id", analytics.ngrams(F.col("w"), 3).alias("grams")), 0.4)


@query("SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def incremental_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT doc_id, (concat('0x', substr(sha256(text), 1, 8))::UBIGINT % 7)::BIGINT AS shard FROM documents")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", ledger.shard(F.col("text"), 7).alias("shard"))


@query("""WITH t AS (SELECT item_id, greatest(length(text), 1) AS n, unnest(list_concat(string_split(lower(text), ''), list_transform(range(1, length(text)), lambda i: substr(lower(text), i, 2)))) AS tok FROM benchmark),
b AS (SELECT item_id, n, (concat('0x', substr(sha256('0:' || tok), 1, 8))::UBIGINT % 16)::INTEGER AS bin FROM t WHERE tok <> '')
SELECT item_id, bin, count(*) / any_value(n) AS weight FROM b GROUP BY item_id, bin""")
def feature_hash_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = embedding.feature_hash(table(spark, sf_dir, "benchmark"), "item_id", "text", 16)
    return v.select("item_id", F.posexplode("vec").alias("bin", "weight")).filter(F.col("weight") > 0)


@query("""WITH p AS (SELECT q.vec_id AS query_id, v.vec_id, round_even(list_dot_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) / (sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) * sqrt(list_dot_product(v.embedding::DOUBLE[], v.embedding::DOUBLE[]))), 6) AS similarity
  FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM p) WHERE rank <= 10""")
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated queries (ids divisible by 50) against all rows."""
    e = table(spark, sf_dir, "embeddings")
    return embedding.top_similar(e, e.filter(F.col("vec_id") % 50 == 0), 10)


@query("SELECT doc_id, doc_id % 3 <> 0 AS reused FROM documents")
def embed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents of three have their vector already; no vector is computed twice."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.lit(0).alias("seq"), F.col("doc_id").cast("string").alias("chunk_id"), F.substring("text", 1, 64).alias("text"))
    known = d.filter(F.col("doc_id") % 3 != 0).select("chunk_id", F.array(F.lit(0.0)).alias("vec"))
    return embedding.embed_missing(d, known, embedding.hash_embedder).select("doc_id", "reused")


@query("SELECT doc_id, doc_id % 3 <> 0 AS reused, CASE WHEN doc_id % 3 = 0 THEN 24 ELSE 1 END::INTEGER AS dim, CASE WHEN doc_id % 3 = 0 AND length(text) > 0 THEN round((2 * length(text) - 1)::DOUBLE / length(text), 6) ELSE 0 END::DOUBLE AS mass FROM documents")
def embed_whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``embed_missing``, with vectors of whole texts: a text of n characters has n of them and n - 1 pairs in its bins."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.lit(0).alias("seq"), F.col("doc_id").cast("string").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = d.filter(F.col("doc_id") % 3 != 0).select("chunk_id", F.array(F.lit(0.0)).alias("vec"))
    mass = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v)
    return embedding.embed_missing(d, known, lambda: embedding.hash_embedder(24)).select("doc_id", "reused", F.size("vec").alias("dim"), F.round(mass, 6).alias("mass"))


@query("SELECT count(*) AS blocks, 0::BIGINT AS exceptions FROM (WITH " + LINES + " SELECT text FROM lines WHERE text <> '')")
def blocks_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second pass of the rules over all text blocks changes none."""
    b = documents.text_blocks(table(spark, sf_dir, "documents"))
    again = text_rules.is_idempotent(F.col("text"))
    return b.select(again.alias("same")).agg(F.count("*").alias("blocks"), F.sum((~F.col("same")).cast("long")).alias("exceptions"))


@query("""WITH pg AS (SELECT doc_id, i AS page_no, list_filter(list_transform(string_split(ps[i], chr(10)), lambda x: trim(x)), lambda x: x <> '') AS ls FROM (SELECT doc_id, string_split(text, chr(10)) AS ps FROM documents), unnest(range(1, len(ps) + 1)) AS t(i)),
e AS (SELECT doc_id, page_no, unnest(list_distinct(ls)) AS line FROM pg)
SELECT doc_id, line, count(*) AS pages FROM e WHERE length(line) > 4 GROUP BY doc_id, line HAVING count(*) >= 2""")
def recurring_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line stands for a page."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return analytics.recurring_lines(d)


@query("SELECT conv_id, turn, running FROM (SELECT conv_id, turn, length(text) AS n, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM conversations) WHERE running - n < 2000")
def preview_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.within_budget(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.length("text"), 2000, True).select("conv_id", "turn", "running")


@query("SELECT conv_id, turn, running FROM (SELECT conv_id, turn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM conversations) WHERE running <= 1200")
def table_char_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.within_budget(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.length("text"), 1200, False).select("conv_id", "turn", "running")


@query("""SELECT doc_id, number FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text || ' [' || doc_id % 5 || '] [12345]', '\\[(\\d{1,4})\\]', 1))) AS number FROM documents)""".replace("\\\\", "\\"))
def citation_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("text", F.concat("text", F.lit(" ["), (F.col("doc_id") % 5).cast("string"), F.lit("] [12345]")))
    return d.select("doc_id", F.explode(references.citations(F.col("text"))).alias("number"))


@query("""SELECT doc_id, '[' || n || ']' AS label, text FROM (SELECT doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) % 9)::VARCHAR AS n, source, trim(string_split(text, chr(10))[1]) AS text, doc_id AS k FROM documents)
QUALIFY row_number() OVER (PARTITION BY source, n ORDER BY length(text) DESC, k) = 1""")
def best_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of entries with one number in a source the longest, the first on ties."""
    n = (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) % 9).cast("string")
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("s"), n.alias("number"), F.trim(F.split("text", "\n", -1)[0]).alias("text"), "doc_id")
    best = references.best_entries(d.select(F.col("s").alias("doc_id"), "number", F.col("doc_id").alias("seq"), "text")).withColumnRenamed("doc_id", "s")
    first = d.join(best, ["s", "number", "text"]).groupBy("s", "number", "text").agg(F.min("doc_id").alias("doc_id"))
    return first.select("doc_id", F.concat(F.lit("["), "number", F.lit("]")).alias("label"), "text")


@query("""WITH e AS (SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) % 9)::VARCHAR AS number, text FROM documents)
SELECT source, number, text FROM e QUALIFY row_number() OVER (PARTITION BY source, number ORDER BY length(text) DESC, doc_id) = 1""")
def best_whole_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``best_references``, with a document's whole text as the entry."""
    n = (F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) % 9).cast("string")
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("doc_id"), n.alias("number"), F.col("doc_id").alias("seq"), "text")
    return references.best_entries(d).withColumnRenamed("doc_id", "source")


@query(f"WITH {LINES} SELECT doc_id, '[' || (seq + 1) || ']' AS label, length(text)::INTEGER AS chars FROM lines WHERE text <> ''")
def bibliographies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a made-up bibliography of all their lines."""
    d = documents.text_blocks(table(spark, sf_dir, "documents"))
    body = d.select("doc_id", "seq", F.lit("paragraph").alias("kind"), F.concat(F.lit("["), (F.col("seq") + 1).cast("string"), F.lit("] "), "text").alias("text"))
    head = d.select("doc_id").distinct().select("doc_id", F.lit(-1).alias("seq"), F.lit("heading").alias("kind"), F.lit("References").alias("text"))
    r = references.extract(body.unionByName(head))
    return r.select("doc_id", F.explode("references").alias("r")).select("doc_id", "r.label", F.length("r.text").alias("chars"))


@query("SELECT doc_id, len(list_filter([text], lambda x: length(x) > 0)) > 0 AS has_text, CASE WHEN length(text) > 0 THEN (length(text) - length(regexp_replace(text, '[.,;:!?]', '', 'g'))) / length(text) ELSE 0 END::DOUBLE AS punctuation, len(string_split(text, chr(10)))::INTEGER AS n_lines FROM documents")
def text_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    share = F.when(F.length(t) > 0, (F.length(t) - F.length(F.regexp_replace(t, "[.,;:!?]", ""))) / F.length(t)).otherwise(0.0)
    return table(spark, sf_dir, "documents").select("doc_id", (F.length(t) > 0).alias("has_text"), share.alias("punctuation"), F.size(F.split(t, "\n", -1)).alias("n_lines"))


@query("SELECT l_orderkey AS doc_id, 0 AS seq, count(*)::INTEGER AS n_rows FROM lineitem GROUP BY l_orderkey")
def continued_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of an order as one-row tables on pages of their own; all continue the first."""
    t = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("seq"), F.col("l_linenumber").alias("page"), F.array(F.lit("part"), F.lit("flag")).alias("header"), F.array(F.array(F.col("l_partkey").cast("string"), F.col("l_returnflag"))).alias("rows"))
    return tables.join_continuations(t).select("doc_id", "seq", F.size("rows").alias("n_rows"))
