"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import (
    bpe, chat_format, decontaminate, filter_audit, importance_sample, license_scan, line_dedup,
    quality_crf, simhash, substring_dedup, token_counts, topk, toxicity,
)
from postloom.llm.common import bucket_of

Query = Callable[[SparkSession, str], DataFrame]

COUNT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CONTEXT = 1024


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(documents)


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf, "documents"), COUNT_TOKENIZER)
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


def _with_fold(scored: DataFrame, modulus: int, rest: int) -> DataFrame:
    held_out = F.coalesce(bucket_of("doc_id", modulus) == rest, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf, "labels"), bucket_of("doc_id", 4) != 2)
    return _with_fold(toxicity.toxicity(documents, model), 4, 2)


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op5_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]")
    hard = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    back = chat_format.read_back(chat_format.format_conversations(rows.unionByName(hard)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf, "documents"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    model = quality_crf.fit(documents, table(spark, sf, "labels"), bucket_of("doc_id", 3) != 1)
    return _with_fold(quality_crf.quality(documents, model), 3, 1)


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf, "documents"), WORD_TOKENIZER, ids=False)


def op9_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


def op10_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), every=50, k=5)


def op11_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(documents).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_importance_sample(spark: SparkSession, sf: str) -> DataFrame:
    drawn = importance_sample.resample(
        table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_substring_dedup, op2_token_counts, op3_toxicity, op4_decontamination, op5_chat_format,
    op6_license_scan, op7_quality, op8_bpe, op9_simhash, op10_topk,
    op11_line_dedup, op12_filter_audit, op13_importance_sample)}

_WORDS = ("list_filter(regexp_split_to_array(translate(coalesce({t}, ''), "
          "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')")

ORACLES: dict[str, str] = {
    "op4_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(t='text')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(t='text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
    FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT r, dw.n, i, item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
places AS (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hit),
cover AS (SELECT r, count(*) AS n_hit FROM places GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN items USING (r)""",
    "op5_chat_format": """
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]'
  FROM (SELECT unnest([0, 1]) AS i)),
-- a control string or a backslash costs one character more, for each of its escapes
c AS (SELECT *, CASE WHEN contains(text, '\\') OR len(list_filter(['</s>', '<|', '|>', '[INST]', '[/INST]', '<s>'],
      lambda m: contains(role, m) OR contains(text, m))) > 0 THEN len(replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\b'),
      '</s>', '\\l/s>'), '<|', '\\l|'), '|>', '\\p>'), '[INST]', '\\sINST]'),
      '[/INST]', '\\s/INST]'), '<s>', '\\ls>')) ELSE len(text) END AS n FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(len(role) + n + 8) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op10_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding,
    lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
  AS INTEGER) AS rank, vec_id, score FROM s
QUALIFY rank <= 5""",
    "op11_line_dedup": """
WITH l AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
r AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, r.k IS NOT NULL AND l.doc_id <> r.keeper AS gone FROM l LEFT JOIN r USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op12_filter_audit": r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
e AS (SELECT t, min(doc_id) AS first FROM w GROUP BY t),
d AS (SELECT part, len(w) < 100 AS fa, 100 * len(list_distinct(w)) < 80 * len(w) AS fb,
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS fc,
    regexp_matches(t, '[#$%&*|]') AS fd, doc_id > first AS fe,
    coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM w JOIN e USING (t) LEFT JOIN labels l USING (doc_id)),
f AS (SELECT 'A' AS x UNION ALL SELECT 'B' UNION ALL SELECT 'C' UNION ALL SELECT 'D' UNION ALL SELECT 'E'),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
g AS (SELECT part, (CASE WHEN fa THEN 'A' ELSE '' END) || (CASE WHEN fb THEN 'B' ELSE '' END)
    || (CASE WHEN fc THEN 'C' ELSE '' END) || (CASE WHEN fd THEN 'D' ELSE '' END)
    || (CASE WHEN fe THEN 'E' ELSE '' END) AS failing, count(*) AS n,
    count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL),
s AS (SELECT part, filter_order, step, filter_order[step] AS filter, n, good, toxic, failing,
    contains(failing, filter_order[step]) AS fails,
    failing <> '' AND translate(filter_order[1:step - 1], failing, '') <> filter_order[1:step - 1] AS earlier
  FROM g, o, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step)),
r AS (SELECT part, filter_order, step, filter,
    coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0) AS kept,
    coalesce(sum(n) FILTER (fails AND NOT earlier), 0) AS removed,
    coalesce(sum(n) FILTER (fails AND earlier), 0) AS redundant,
    coalesce(sum(n) FILTER (failing = filter), 0) AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT earlier), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r""",
    "op13_importance_sample": f"""
WITH crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i))),
d AS (SELECT doc_id, {_WORDS.format(t='text')} AS w FROM documents),
b AS (SELECT {_WORDS.format(t='text')} AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word FROM d), bw AS (SELECT unnest(w) AS word FROM b),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bytes AS (SELECT word, list_transform(range(len(h) // 2),
    lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS l FROM hexed),
buckets AS (SELECT word, xor(list_reduce(l, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295),
    4294967295) % 10000 AS bucket FROM bytes, crc_table),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE
    * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(gain) AS weight FROM dw JOIN buckets USING (word)
  JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights ON weights.doc_id = d.doc_id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
    count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked r ON r.doc_id = s.doc_id""",
}
