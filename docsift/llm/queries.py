"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import (
    chat, decontamination, fingerprints, importance, licenses, merkle, ngram_join, packing, quality, sharding, substring_dedup, token_counts, toxicity,
)
from docsift.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: CRC-32 of a list of bytes (as numbers), from a table made by its rule.
_CRC = """(SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), b::BIGINT)) AS t)"""


def _crc32(data: str, table: str = "crc.t") -> str:
    return f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def _bytes(text: str) -> str:
    return f"list_transform(range(1, 2 * octet_length(encode({text})), 2), lambda i: concat('0x', substr(hex(encode({text})), i, 2))::BIGINT)"


#: SQL of the same results for DuckDB. The model of op7 and op8, the tokenizer of op5 and op6, the ring of op13,
#: the tilings of op2 and the sentences of op3 have none; tests compare them with brute force.
ORACLES: dict[str, str] = {
    "op11_merkle": f"""WITH RECURSIVE crc AS {_CRC}, fields AS (SELECT *, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') AS f1,
  coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS f2,
  coalesce(octet_length(encode(text)) || ':' || text, '-') AS f4, coalesce({_crc32("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)")} % 7 = 0, false) AS bad FROM documents, crc),
leaves AS (SELECT doc_id, lang, sha256(concat(f1, f2, coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-'), f4)) AS leaf,
  CASE WHEN bad THEN sha256(concat(f1, f2, coalesce(length((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-'), f4)) END AS changed FROM fields),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
low AS (SELECT 0 AS level, lang, n, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY lang, n
  UNION ALL SELECT level + 1, lang, n, list_transform(range(0, len(nodes), 2), lambda i: sha256(concat(nodes[i + 1], nodes[i + 2]))) FROM low WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM low WHERE len(nodes) = 1),
high AS (SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(concat(nodes[i + 1], nodes[i + 2]))) FROM high WHERE len(nodes) > 1),
paths AS (SELECT p.doc_id, p.lang, p.place, list(CASE WHEN (p.place >> w.level) % 2 = 1 THEN '<' || w.nodes[p.place >> w.level]
    ELSE '>' || coalesce(w.nodes[(p.place >> w.level) + 2], '') END ORDER BY w.level) FILTER (WHERE len(w.nodes) > 1) AS up
  FROM placed p JOIN low w ON p.lang IS NOT DISTINCT FROM w.lang GROUP BY ALL),
tops AS (SELECT s.lang, s.subroot, list(CASE WHEN (s.place >> h.level) % 2 = 1 THEN '<' || h.nodes[s.place >> h.level]
    ELSE '>' || coalesce(h.nodes[(s.place >> h.level) + 2], '') END ORDER BY h.level) FILTER (WHERE len(h.nodes) > 1) AS up FROM subroots s, high h GROUP BY ALL),
folded AS (SELECT p.doc_id, p.leaf, t.subroot, (SELECT nodes[1] FROM high WHERE len(nodes) = 1) AS root, coalesce(a.up, []) || coalesce(t.up, []) AS up, coalesce(p.changed, p.leaf) AS start
  FROM placed p JOIN paths a ON p.lang IS NOT DISTINCT FROM a.lang AND p.place = a.place JOIN tops t ON p.lang IS NOT DISTINCT FROM t.lang),
roots AS (SELECT *, list_reduce(up, lambda x, s: sha256(CASE WHEN s[1] = '<' THEN concat(s[2:], x) ELSE concat(x, s[2:]) END), start) AS folded_root FROM folded)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(up, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM roots""",
    "op12_importance": f"""WITH crc AS {_CRC}, texts AS (SELECT 'd' AS side, row_number() OVER () AS row, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
found AS (SELECT side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT side, row, array_to_string(w[i : i + k - 1], ' ') AS f FROM (SELECT side, row, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM found, (SELECT unnest([1, 2, 3]) AS k))),
names AS (SELECT f, {_crc32(_bytes('f'))} % 10000 AS bucket FROM (SELECT DISTINCT f FROM runs), crc),
counted AS (SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t FROM runs JOIN names USING (f) GROUP BY bucket),
sums AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counted),
gained AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain FROM counted, sums),
weights AS (SELECT row, count(*) AS n, sum(gain)::BIGINT AS weight FROM runs JOIN names USING (f) JOIN gained USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((concat('0x', substr(sha256(concat('42:', doc_id)), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM found LEFT JOIN weights USING (row) WHERE side = 'd'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS r, count(*) OVER (PARTITION BY n_words >= 20) AS n_long FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= n_long * 5 // 100 THEN r END AS rank, n_words FROM ranked""",
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path())


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), tokenizer_path())
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query
def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.read_back(chat.format_turns(chat.probe(table(spark, folder, "conversations"))))


@query
def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited(table(spark, folder, "documents"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query
def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_components(table(spark, folder, "documents"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    return merkle.manifest(table(spark, folder, "documents"), tampered)


@query
def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"), 40)
