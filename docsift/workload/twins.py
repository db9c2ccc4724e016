"""The same results as SQL, for DuckDB over the same tables."""

from __future__ import annotations

from .spark_queries import CACHE_TAU, COMPANY

WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '{WS}'), lambda t: t <> '')"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{WS}', ''), '{WS}$', '')"


def _nine(c: str) -> str:
    return f"CASE WHEN round({c}, 9) = 0 THEN 0.0::DOUBLE ELSE round({c}, 9) END"


FILES = "files AS (SELECT doc_id, lang, text, concat('doc_', doc_id, '.txt') AS source FROM documents)"
CHUNKS = f"""{FILES},
windows AS (SELECT doc_id, lang, source, {_words('text')} AS w FROM files),
cut AS (SELECT doc_id, lang, source, unnest(range(0, len(w), 448)) AS start, w FROM windows),
joined AS (SELECT doc_id, lang, source, start, array_to_string(w[start + 1 : start + 512], ' ') AS text FROM cut),
chunks AS (SELECT doc_id, lang, source, text,
  row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS chunk_index,
  concat(source, '_chunk_', row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1) AS id
  FROM joined WHERE length(text) > 20)"""


def _embed(name: str, source: str, key: str, extra: str = "") -> str:
    """CTE ``name`` with ``key``, ``extra`` and the hashed unit vector of ``text``."""
    return f"""{name}_b AS (SELECT {key}{extra}, list_transform({_words('text')},
  lambda t: concat('0x', substr(md5(t), 1, 8))::UBIGINT % 64) AS b FROM {source}),
{name}_c AS (SELECT * EXCLUDE (b), list_transform(range(64), lambda i: len(list_filter(b, lambda x: x = i))::DOUBLE) AS c FROM {name}_b),
{name} AS (SELECT * EXCLUDE (c), list_transform(c, lambda x: CASE WHEN list_sum(list_transform(c, lambda y: y * y)) > 0
  THEN (x / sqrt(list_sum(list_transform(c, lambda y: y * y))))::FLOAT ELSE 0.0::FLOAT END)::DOUBLE[] AS e FROM {name}_c)"""


CENTROIDS = """items AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
means AS (SELECT label, i, avg(x) AS x FROM items GROUP BY label, i),
centroids AS (SELECT label::BIGINT AS question_id, list(x ORDER BY i) AS q FROM means GROUP BY label)"""


def _hits(k: int, where: str = "TRUE") -> str:
    return f"""{CENTROIDS},
pairs AS (SELECT question_id, vec_id AS id, {_nine('1 - list_cosine_similarity(q, embedding::DOUBLE[])')} AS distance, label
  FROM centroids, embeddings WHERE {where}),
hits AS (SELECT question_id, row_number() OVER (PARTITION BY question_id ORDER BY distance, id) AS rank, id, distance, label
  FROM pairs QUALIFY rank <= {k})"""


def _overlap(a: str, r: str) -> str:
    """Score read from the judge's sentence about two word lists."""
    sa, sr = f"list_distinct({_words(a)})", f"list_distinct({_words(r)})"
    share = f"CASE WHEN len({sa}) = 0 THEN 0.0 ELSE len(list_intersect({sa}, {sr}))::DOUBLE / len({sa}) END"
    return f"printf('%.4f', {share})::DOUBLE"


SCORED = f"""firsts AS (SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic, lower(d.text) AS chunk
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
asked AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id, quality, text AS truth,
  concat('What is said in ', source, ' (', lang, '): ', text, '?') AS question,
  CASE WHEN quality = 1 THEN chunk ELSE 'ERROR: no answer' END AS answer,
  CASE WHEN quality = 1 AND toxic <> 1 THEN text ELSE '' END AS context FROM firsts),
judged AS (SELECT id, doc_id, quality,
  CASE WHEN answer = '' OR context = '' THEN 0.0 ELSE {_overlap('answer', 'context')} END AS faithfulness,
  CASE WHEN answer = '' OR question = '' THEN 0.0 ELSE {_overlap('answer', 'question')} END AS relevancy,
  CASE WHEN answer = '' OR truth = '' THEN 0.0 ELSE {_overlap('answer', 'truth')} END AS correctness FROM asked),
scored AS (SELECT *, (faithfulness + relevancy + correctness) / 3.0 AS average,
  (faithfulness + relevancy + correctness) / 3.0 < 0.6 AS flagged FROM judged)"""


def _clean(c: str) -> str:
    return f"lower({_strip(c)})"


def _field(name: str) -> str:
    p, t = f"p_{name}", f"t_{name}"
    return f"""CASE WHEN {t} = '' THEN CASE WHEN {p} = '' THEN 1.0 ELSE 0.0 END WHEN {p} = {t} THEN 1.0
  WHEN contains({t}, {p}) OR contains({p}, {t}) THEN 0.5 ELSE 0.0 END::DOUBLE AS {name}"""


_RAW = {"company": "p_name", "date": "p_brand", "address": "p_type", "total": "p_size::VARCHAR"}
RECEIPTS = f"""cleaned AS (SELECT p_partkey AS receipt_id,
  {', '.join(f"{_clean(c)} AS t_{n}" for n, c in _RAW.items())},
  {', '.join(f"{_clean(f'''CASE p_partkey % 5 WHEN 0 THEN {c} WHEN 1 THEN concat('  ', upper({c}), chr(10)) WHEN 2 THEN substr({c}, 1, 3) WHEN 3 THEN '' ELSE 'zzz' END''')} AS p_{n}" for n, c in _RAW.items())} FROM part),
fields AS (SELECT receipt_id, {', '.join(_field(n) for n in _RAW)},
  {' AND '.join(f'p_{n} = t_{n}' for n in _RAW)} AS exact_match FROM cleaned),
receipts AS (SELECT receipt_id, company, date, address, total, (company + date + address + total) / 4.0 AS macro_f1, exact_match FROM fields)"""


_PAGE = ("(l_partkey * 13 + l_linenumber * 31) % 900", "(l_suppkey * 17 + l_quantity::BIGINT * 7) % 1200", "l_quantity::BIGINT + 20", "TRUE")
_WIDE_PAGE = ("(l_partkey * 7919 + l_orderkey * 31 + l_linenumber * 104729) % 8000000", "(l_suppkey * 15485863 + l_orderkey * 17) % 8000000", "l_linenumber", "l_partkey % 10 <> 3")


def _links(doc: str, page: tuple[str, str, str, str] = _PAGE) -> str:
    x, y, wide, placed = page
    return f"""tokens AS (SELECT {doc} AS doc_id, concat_ws('-', lpad(l_linenumber::VARCHAR, 2, '0'), lpad(l_orderkey::VARCHAR, 12, '0'),
  lpad(l_partkey::VARCHAR, 12, '0'), lpad(l_suppkey::VARCHAR, 12, '0'), lpad(round(l_extendedprice * 100)::BIGINT::VARCHAR, 12, '0')) AS pos, concat('part ', l_partkey) AS text,
  l_linenumber % 2 = 1 AS asks, {x} AS x, {y} AS y, {wide} AS wide, l_linenumber + 10 AS high,
  round(1.0 - l_discount * 2, 4) AS confidence FROM lineitem WHERE {placed}),
boxes AS (SELECT doc_id, pos, text, asks, confidence, x AS x1, y AS y1, x + wide AS x2, y + high AS y2, 2 * x + wide AS cx, 2 * y + high AS cy FROM tokens),
nearest AS (SELECT q.doc_id, q.pos AS question_pos, any_value(q.text) AS question,
  min(((a.cx - q.cx) * (a.cx - q.cx) + (a.cy - q.cy) * (a.cy - q.cy), a.pos)) AS best
  FROM boxes q JOIN boxes a ON q.doc_id = a.doc_id WHERE q.asks AND NOT a.asks GROUP BY q.doc_id, q.pos),
links AS (SELECT n.doc_id, n.question_pos, n.question, a.pos AS answer_pos, a.text AS answer, a.confidence,
  sqrt(best[1]::DOUBLE) / 2 AS distance, a.x1, a.y1, a.x2, a.y2
  FROM nearest n JOIN boxes a ON a.doc_id = n.doc_id AND a.pos = n.best[2])"""


_CLEARED = """statuses AS (SELECT t.doc_id, coalesce(l.n, 0) AS n_fields, coalesce(l.low, 0) AS n_flagged FROM (SELECT DISTINCT doc_id FROM boxes) t
  LEFT JOIN (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE confidence < 0.85) AS low FROM links GROUP BY doc_id) l ON l.doc_id = t.doc_id)"""
_STATUS = "CASE WHEN n_flagged > 0 THEN 'MANUAL_REVIEW_REQUIRED' ELSE 'CLEARED' END"

EMAIL = r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+"
PHONE = r"\p{Nd}{3}-\p{Nd}{3}-\p{Nd}{4}"
_PII = f"regexp_matches(text, '{EMAIL}') OR regexp_matches(text, '{PHONE}')"
_NAME = "concat('[', CASE WHEN contains(v, '@') THEN 'EMAIL' ELSE 'PHONE' END, '_', base + list_position(vals, v), ']')"
REDACTED = f"""found AS (SELECT doc_id, string_split_regex(text, '{EMAIL}|{PHONE}') AS parts, regexp_extract_all(text, '{EMAIL}|{PHONE}') AS hits,
  coalesce(list_max(list_transform(regexp_extract_all(text, '\\[(?:EMAIL|PHONE)_([0-9]{{1,9}})\\]', 1), lambda n: n::BIGINT)), 0) AS base FROM documents),
named AS (SELECT *, list_filter(hits, lambda v, i: list_position(hits, v) = i) AS vals FROM found),
redacted AS (SELECT doc_id, array_to_string(list_transform(range(1, len(parts) + 1), lambda i: concat(parts[i], list_transform(hits, lambda v: {_NAME})[i])), '') AS redacted,
  array_to_string(list_transform(vals, lambda v: concat({_NAME}, '=', v)), ';') AS placeholders FROM named)"""

KINDS = f"{EMAIL}|{PHONE}|" + r"\b[0-9]{4}(?:[ -]?[0-9]{4}){3}\b|\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
_KIND = "CASE WHEN contains(v, '@') THEN 'EMAIL' WHEN v[1] = '+' THEN 'CALLER' WHEN length(v) >= 16 THEN 'CARD' ELSE 'PHONE' END"
_KIND_NAME = f"concat('[', {_KIND}, '_', base + list_position(vals, v), ']')"
KINDS_REDACTED = f"""found AS (SELECT doc_id, text, string_split_regex(text, '{KINDS}') AS parts, regexp_extract_all(text, '{KINDS}') AS hits,
  coalesce(list_max(list_transform(regexp_extract_all(text, '\\[[A-Z][A-Z_]*_([0-9]{{1,9}})\\]', 1), lambda n: n::BIGINT)), 0) AS base FROM documents),
named AS (SELECT *, list_filter(hits, lambda v, i: list_position(hits, v) = i) AS vals FROM found)"""

MAIL_TEXT = f"concat('Company notes:', chr(10), '{COMPANY}', chr(10), chr(10), 'Mail to handle:', chr(10), text)"
_PRIVACY = f"CASE WHEN {_PII} THEN 'FLAGGED (Contains PII)' ELSE 'PASSED' END"
TRIAGE = """inbound AS (SELECT *, length(text) AS n FROM conversations WHERE role = 'user'),
sorted AS (SELECT *, ['urgent', 'normal', 'low'][n % 3 + 1] AS p, ['complaint', 'request'][n % 2 + 1] AS t FROM inbound),
replied AS (SELECT *, CASE WHEN n % 7 = 0 THEN 'cannot tell' ELSE concat('{"priority": "', p, '", "type": "', t, '"}') END AS classification FROM sorted)"""

EVENTS = """reviews AS (SELECT conv_id AS mail_id, turn AS seq, role = 'assistant' AS draft,
  role = 'assistant' AND turn % 4 <> 1 AS remark, CASE WHEN role = 'assistant' THEN text END AS response,
  CASE WHEN role = 'user' AND turn > 1 THEN length(text) % 2 = 0 END AS approved FROM conversations),
starts AS (SELECT mail_id, max(seq) AS start FROM reviews WHERE draft AND NOT remark GROUP BY mail_id)"""

SOURCES = """firsts AS (SELECT source, doc_id, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM documents),
sources AS (SELECT source, doc_id, text FROM firsts WHERE place <= 20 AND length(text) > 100)"""

CALLS = f"""WITH l AS (SELECT event_type, value, json_extract_string(props, '$.k')::BIGINT AS k,
  CASE WHEN value > 0 THEN floor(ln(value) / ln(1.02::DOUBLE))::INT ELSE -1073741824 END AS b FROM events),
c AS (SELECT event_type, b, sum(count(*)) OVER (PARTITION BY event_type ORDER BY b) AS seen, sum(count(*)) OVER (PARTITION BY event_type) AS n FROM l GROUP BY event_type, b),
q AS (SELECT event_type, min(b) AS b FROM c WHERE seen >= ceil(n * 0.95::DOUBLE) GROUP BY event_type)
SELECT event_type AS prompt_version, count(*) AS calls, {_nine('avg(value)')} AS avg_latency, max(value) AS max_latency,
  {_nine('CASE WHEN any_value(q.b) = -1073741824 THEN 0.0::DOUBLE ELSE pow(1.02::DOUBLE, any_value(q.b) + 1) * (2 / 2.02::DOUBLE) END')} AS p95_latency,
  sum(k)::BIGINT AS tokens_in, sum(k * 3)::BIGINT AS tokens_out,
  {_nine('(sum(k)::DOUBLE * 0.15 + sum(k * 3)::DOUBLE * 0.60) / 1e6')} AS cost, {_nine('avg((value > 20)::INT::DOUBLE)')} AS error_rate FROM l JOIN q USING (event_type) GROUP BY event_type"""

TWINS: dict[str, str] = {
    "chunk_documents": f"WITH {CHUNKS} SELECT id, text, source, chunk_index FROM chunks",
    "chunk_manifest": f"WITH {CHUNKS} SELECT (SELECT count(*) FROM documents) AS total_documents, (SELECT count(*) FROM chunks) AS total_chunks",
    "vector_topk": f"WITH {_hits(5)} SELECT question_id, rank, id, distance FROM hits",
    "vector_topk_filtered": f"WITH {_hits(5, 'label >= 5')} SELECT question_id, rank, id, distance FROM hits",
    "vector_topk_cells": f"WITH {_hits(5)} SELECT question_id, rank, id, distance FROM hits",
    "vector_neighbours": f"""WITH pairs AS (SELECT q.vec_id AS question_id, v.vec_id AS id, {_nine('1 - list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[])')} AS distance
  FROM embeddings q, embeddings v)
SELECT question_id, row_number() OVER (PARTITION BY question_id ORDER BY distance, id) AS rank, id, distance FROM pairs QUALIFY rank <= 4""",
    "rag_context": f"""WITH {CHUNKS}, {_embed('v', 'chunks', 'id', ', text, source, chunk_index')}, {_embed('q', 'benchmark', 'item_id')},
pairs AS (SELECT item_id, id, text, source, chunk_index, {_nine('1 - list_cosine_similarity(q.e, v.e)')} AS d FROM q, v),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY d, id) AS rank FROM pairs QUALIFY rank <= 5)
SELECT item_id AS question_id, string_agg(concat('[', rank, '] ', text), chr(10) || chr(10) ORDER BY rank) AS retrieved_context,
  string_agg(concat(source, '#', chunk_index), ';' ORDER BY rank) AS cited, count(*) AS chunks_used FROM ranked GROUP BY item_id""",
    "ingest_new_only": f"WITH {CHUNKS} SELECT id, length(text) AS n_chars FROM chunks WHERE lang <> 'en'",
    "cached_answers": f"""WITH {_embed('p', 'documents', 'doc_id')}, {_embed('c', 'benchmark', 'item_id')},
pairs AS (SELECT doc_id, item_id, {_nine('1 - list_cosine_similarity(p.e, c.e)')} AS distance FROM p, c),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, item_id) = 1)
SELECT doc_id AS question_id, item_id AS id, distance, concat('answer to ', item_id) AS answer FROM best WHERE distance <= {CACHE_TAU}""",
    "cached_answers_cells": f"""WITH {_embed('p', 'documents', 'doc_id')}, {_embed('c', 'benchmark', 'item_id')},
pairs AS (SELECT doc_id, item_id, {_nine('1 - list_cosine_similarity(p.e, c.e)')} AS distance FROM p, c),
best AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, item_id) = 1)
SELECT doc_id AS question_id, item_id AS id, distance, concat('answer to ', item_id) AS answer FROM best WHERE distance <= {CACHE_TAU}""",
    "cache_misses": f"""WITH {_embed('p', 'documents', 'doc_id')}, {_embed('c', 'benchmark', 'item_id')},
pairs AS (SELECT doc_id, {_nine('1 - list_cosine_similarity(p.e, c.e)')} AS distance FROM p, c)
SELECT doc_id AS question_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM pairs WHERE distance <= {CACHE_TAU})""",
    "rerank": f"""WITH {_hits(20)},
again AS (SELECT h.question_id, h.id, {_nine('-list_sum(list_transform(range(1, 65), lambda i: abs(c.q[i] - e.embedding[i]::DOUBLE)))')} AS rerank_score
  FROM hits h JOIN centroids c ON c.question_id = h.question_id JOIN embeddings e ON e.vec_id = h.id)
SELECT question_id, row_number() OVER (PARTITION BY question_id ORDER BY rerank_score DESC, id) AS rank, id, rerank_score FROM again QUALIFY rank <= 5""",
    "source_cards": """SELECT doc_id, CASE WHEN lang <> 'es' THEN source ELSE 'Unknown' END AS source,
  CASE lang WHEN 'de' THEN n_chars::VARCHAR WHEN 'fr' THEN 'fr' ELSE 'N/A' END AS place,
  concat(substr(text, 1, 150), CASE WHEN length(text) > 150 THEN '...' ELSE '' END) AS excerpt FROM documents""",
    "score_parse": r"""SELECT doc_id, coalesce(try_cast(nullif(regexp_extract(text,
  '(?:^|[^\p{L}\p{M}\p{Nd}_])(0\.[0-9]+|1\.0|0|1)(?:$|[^\p{L}\p{M}\p{Nd}_])', 1), '') AS DOUBLE), 0.5) AS score FROM documents""",
    "evaluate_rows": f"WITH {SCORED} SELECT id, doc_id, faithfulness, relevancy, correctness, {_nine('average')} AS average, flagged FROM scored",
    "evaluate_summary": f"""WITH {SCORED} SELECT count(*) AS total_questions, {', '.join(f"{_nine(f'avg({m})')} AS avg_{m}" for m in ('faithfulness', 'relevancy', 'correctness'))},
  count(*) FILTER (WHERE flagged) AS flagged_count, {_nine('count(*) FILTER (WHERE flagged)::DOUBLE / count(*)')} AS flag_rate FROM scored""",
    "judge_alignment": f"""WITH {SCORED}, ranked AS (SELECT doc_id, average AS s, quality::DOUBLE AS l, rank() OVER (ORDER BY average) + (count(*) OVER (PARTITION BY average) - 1) / 2 AS rs,
  rank() OVER (ORDER BY quality) + (count(*) OVER (PARTITION BY quality) - 1) / 2 AS rl FROM scored),
signs AS (SELECT sum(sign(a.s - b.s) * sign(a.l - b.l)) AS k, sum((a.s <> b.s)::INT) AS ns, sum((a.l <> b.l)::INT) AS nl FROM ranked a JOIN ranked b ON a.doc_id < b.doc_id)
SELECT count(*) AS n_pairs, round(corr(s, l), 9) AS correlation, round(avg(abs(s - l)), 9) AS mean_abs_gap, round(corr(rs, rl), 9) AS spearman,
  round(any_value(k / sqrt(ns::DOUBLE * nl)), 9) AS kendall FROM ranked, signs""",
    "context_precision": f"""WITH {_hits(5)} SELECT question_id, avg(CASE WHEN label = question_id THEN 1.0 ELSE 0.0 END) AS context_precision FROM hits GROUP BY question_id""",
    "target_check": f"""WITH {SCORED}, rows AS (SELECT 'faithfulness' AS metric, avg(faithfulness) AS value, 0.85::DOUBLE AS target FROM scored
  UNION ALL SELECT 'relevancy', avg(relevancy), 0.80::DOUBLE FROM scored UNION ALL SELECT 'correctness', avg(correctness), 0.70::DOUBLE FROM scored)
SELECT metric, {_nine('value')} AS value, target, value > target AS met FROM rows""",
    "score_bands": """WITH v AS (SELECT *, 1.0::DOUBLE - l_discount * 3 AS v FROM lineitem), w AS (SELECT *, floor(v * 100 * 10 + 0.5::DOUBLE)::BIGINT AS tenths FROM v)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN v >= 0.85 THEN 'low' WHEN v >= 0.7 THEN 'normal' ELSE 'urgent' END AS band,
  concat(tenths // 10, '.', tenths % 10, '%') AS percent FROM w""",
    "field_scores": f"WITH {RECEIPTS} SELECT receipt_id, company, date, address, total, macro_f1, exact_match FROM receipts",
    "exact_match_rate": f"""WITH {RECEIPTS} SELECT count(*) AS n_receipts, {', '.join(f"{_nine(f'avg({n})')} AS avg_{n}" for n in _RAW)},
  {_nine('avg(macro_f1)')} AS field_f1, {_nine('avg(exact_match::INT::DOUBLE)')} AS exact_match FROM receipts""",
    "box_links": f"WITH {_links('l_orderkey')} SELECT doc_id, question_pos, answer_pos, answer, confidence, distance FROM links",
    "box_links_large": f"WITH {_links('l_returnflag')} SELECT doc_id, question_pos, answer_pos, answer, confidence, distance FROM links",
    "box_links_wide": f"WITH {_links('l_returnflag', _WIDE_PAGE)} SELECT doc_id, question_pos, answer_pos, answer, confidence, distance FROM links",
    "document_clearance": f"WITH {_links('l_orderkey')}, {_CLEARED} SELECT doc_id, {_STATUS} AS document_status, n_fields, n_flagged FROM statuses",
    "clearance_records": f"""WITH {_links('l_orderkey')}, {_CLEARED}, placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY question_pos) - 1 AS place FROM links),
parts AS (SELECT doc_id, place // 500 AS part, string_agg(concat_ws('|', question, '[REDACTED]', CASE WHEN confidence < 0.85 THEN 'FLAGGED_FOR_REVIEW' ELSE 'PROCESSED' END), ';' ORDER BY place) AS fields
  FROM placed GROUP BY doc_id, place // 500)
SELECT s.doc_id, coalesce(p.part, 0) AS part, {_STATUS} AS document_status, coalesce(p.fields, '') AS fields FROM statuses s LEFT JOIN parts p ON p.doc_id = s.doc_id""",
    "redaction_boxes": f"WITH {_links('l_orderkey')} SELECT DISTINCT doc_id, x1::INT AS x1, y1::INT AS y1, x2::INT AS x2, y2::INT AS y2 FROM links",
    "confidence_route": """SELECT l_returnflag, CASE WHEN 1.0::DOUBLE - l_tax > 0.95 THEN 'auto' ELSE 'review' END AS route, count(*) AS n FROM lineitem GROUP BY ALL""",
    "pair_by_stem": "SELECT d.doc_id::VARCHAR AS stem, d.text AS input, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "normalise_receipts": f"""SELECT doc_id, CASE WHEN lang = 'en' THEN text ELSE array_to_string({_words('text')}, ' ') END AS input,
  source AS company, '' AS date, CASE WHEN lang <> 'de' THEN lang ELSE '' END AS address, n_chars::VARCHAR AS total FROM documents""",
    "training_text": f"""WITH t AS (SELECT doc_id, concat('### Receipt:', chr(10), text, chr(10), chr(10), '### Extracted Fields:', chr(10), '{{"lang": "', lang, '"}}') AS t FROM documents),
w AS (SELECT doc_id, t, {_words('t')} AS w FROM t) SELECT doc_id, CASE WHEN len(w) <= 512 THEN t ELSE array_to_string(w[1:512], ' ') END AS training_text FROM w""",
    "ordered_split": """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS "index", count(*) OVER () AS n FROM documents)
SELECT doc_id, "index", CASE WHEN "index" < floor(n * (1 - 0.15::DOUBLE)) THEN 'train' ELSE 'validation' END AS split FROM n""",
    "line_index": """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_returnflag,
  row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey) - 1 AS position, count(*) OVER () AS n_lines,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey) - 1 AS flag_position,
  count(*) OVER (PARTITION BY l_returnflag) AS n_flag FROM lineitem""",
    "extract_fallback_stub": """WITH n AS (SELECT doc_id, length(text) AS n FROM documents)
SELECT doc_id, CASE WHEN n % 3 = 2 OR (n % 3 = 0 AND n % 5 <> 0) THEN concat('c', n % 10) END AS company,
  CASE WHEN n % 3 = 2 OR (n % 3 = 0 AND n % 5 <> 0) THEN 'None' END AS date,
  CASE WHEN n % 3 = 2 OR (n % 3 = 0 AND n % 5 <> 0) THEN '' END AS address,
  CASE WHEN n % 3 = 2 OR (n % 3 = 0 AND n % 5 <> 0) THEN concat(n, '.00') END AS total,
  CASE WHEN n % 3 = 1 THEN 'no fields seen' WHEN n % 15 = 0 THEN 'none' END AS raw_output,
  CASE WHEN n % 3 = 0 THEN 'api-fallback' ELSE 'fine-tuned-local' END AS model, n % 3 = 0 AS requires_review,
  CASE WHEN n % 15 = 0 THEN 'reply is not one JSON object' END AS error FROM n""",
    "field_json": "SELECT event_id, props AS cut, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
    "head_per_group": "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 20",
    "corpus_sample": """WITH k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents WHERE length(text) > 200)
SELECT doc_id, printf('arxiv_%04d', i) AS name FROM k WHERE i < 100""",
    "qa_sources": f"WITH {SOURCES} SELECT source, doc_id, text FROM sources",
    "generate_qa_stub": """WITH n AS (SELECT source, doc_id, length(text) AS n FROM documents WHERE length(text) > 100),
p AS (SELECT source, doc_id, n, unnest([0, 1, 2])::BIGINT AS pair FROM n WHERE n % 2 = 0)
SELECT source, doc_id, pair, concat('q', pair, ' of ', n) AS question, concat('a', pair) AS answer, false AS verified FROM p""",
    "cap_pairs": "SELECT conv_id, turn, text AS question, false AS verified FROM conversations ORDER BY conv_id, turn LIMIT 50",
    "complete_stub": """SELECT doc_id, concat(lang, ' of ', source) AS prompt, concat(length(concat(lang, ' of ', source)), ' characters') AS reply, NULL::VARCHAR AS reply_error FROM documents""",
    "extend_gold": """WITH u AS (SELECT text AS question, true AS verified, turn FROM conversations WHERE role = 'user')
SELECT question, verified FROM u WHERE turn = 0 UNION ALL SELECT question, verified FROM u WHERE question NOT IN (SELECT question FROM u WHERE turn = 0)""",
    "extend_training": """WITH r AS (SELECT concat('receipt ', l_partkey) AS input, CASE WHEN l_linenumber > 1 THEN date_trunc('month', l_shipdate) END AS v,
  concat('{"company":"shop ', l_suppkey, '","total":"', CASE WHEN l_returnflag <> 'N' THEN l_quantity::BIGINT::VARCHAR ELSE '?' END, '"}') AS f FROM lineitem WHERE l_linenumber < 7),
n AS (SELECT input, f AS new FROM r QUALIFY row_number() OVER (PARTITION BY input ORDER BY v DESC NULLS LAST, f DESC) = 1),
o AS (SELECT concat('receipt ', p_partkey) AS input, concat('{"company":"', p_name, '"}') AS output FROM part WHERE p_partkey % 2 = 0)
SELECT coalesce(n.input, o.input) AS input, coalesce(new, output) AS output, new IS NOT NULL AS reviewed FROM o FULL JOIN n ON o.input = n.input""",
    "mail_clean": f"""WITH m AS (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 500),
b AS (SELECT doc_id, {_strip("CASE WHEN instr(text, chr(10) || chr(10)) > 0 THEN substr(text, instr(text, chr(10) || chr(10)) + 2) ELSE text END")} AS email_text FROM m)
SELECT doc_id, email_text FROM b WHERE length(email_text) > 50""",
    "mail_body": f"SELECT conv_id, turn, {_strip('text')} AS body FROM conversations",
    "pii_scan": f"SELECT doc_id, {_PII} AS pii_found, {_PRIVACY} AS privacy_scan, {MAIL_TEXT} AS contextual_text FROM documents",
    "pii_redact": f"WITH {REDACTED} SELECT doc_id, redacted, placeholders FROM redacted",
    "pii_redact_kinds": f"""WITH {KINDS_REDACTED} SELECT doc_id AS mail_id, array_to_string(list_transform(range(1, len(parts) + 1), lambda i: concat(parts[i], list_transform(hits, lambda v: {_KIND_NAME})[i])), '') AS redacted,
  array_to_string(list_transform(vals, lambda v: concat({_KIND_NAME}, '=', v)), ';') AS placeholders, text AS restored FROM named""",
    "rehydrate": "SELECT doc_id AS mail_id, text AS response FROM documents",
    "triage_user_turns": f"""WITH {TRIAGE} SELECT conv_id, turn, classification, CASE WHEN n % 7 = 0 THEN '—' ELSE p END AS priority,
  CASE WHEN n % 7 = 0 THEN '—' ELSE t END AS type, concat('Reply to ', n, ' characters, sorted as ', classification) AS response,
  {_PRIVACY} AS privacy_scan, true AS requires_approval FROM replied""",
    "review_fold": f"""WITH {EVENTS} SELECT r.mail_id, count(*) FILTER (WHERE draft AND remark AND (start IS NULL OR seq > start)) AS revision_count,
  arg_max(response, seq) FILTER (WHERE draft) AS response, arg_max(approved, seq) FILTER (WHERE approved IS NOT NULL) AS approved
FROM reviews r LEFT JOIN starts s ON s.mail_id = r.mail_id GROUP BY r.mail_id""",
    "approval_map": """SELECT conv_id, turn, CASE WHEN length(text) % 2 = 0 THEN 'approved' ELSE 'rejected' END AS status,
  CASE WHEN length(text) % 2 = 0 THEN 'email_sent' ELSE 'archived_for_review' END AS action FROM conversations""",
    "customer_lookup": """WITH c AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS tier FROM customer
  UNION ALL SELECT c_custkey, concat('A former ', c_name), 'NONE' FROM customer WHERE c_acctbal < 0),
f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY name) = 1)
SELECT o_orderkey, concat('c', o_custkey * 2, '@example.com') AS email, name, tier FROM orders LEFT JOIN f ON f.k = o_custkey * 2""",
    "classification_parse": """SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type WHEN 1 THEN event_type ELSE '—' END AS priority,
  CASE event_id % 5 WHEN 0 THEN 'info' WHEN 2 THEN event_type ELSE '—' END AS type FROM events""",
    "feedback_append": """SELECT concat(conv_id, '/', turn) AS question, text AS answer, CASE WHEN turn > 3 THEN 'missing_source' ELSE 'bad_answer' END AS reason,
  'flagged' AS status FROM conversations WHERE role = 'assistant'""",
    "call_stats": CALLS,
    "call_stats_by_day": CALLS,
    "review_queue": f"""WITH {SCORED}, {_links('l_orderkey')}
SELECT 'answer' AS kind, doc_id::VARCHAR AS item_id, 'low score' AS reason, {_nine('average')} AS score FROM scored WHERE flagged
UNION ALL SELECT 'field', concat(doc_id, ':', question_pos), 'low confidence', confidence FROM links WHERE confidence < 0.85
UNION ALL SELECT 'draft', concat(conv_id, ':', turn), 'approval', NULL FROM conversations WHERE role = 'assistant'
UNION ALL SELECT 'feedback', concat(conv_id, '/', turn), CASE WHEN turn > 3 THEN 'missing_source' ELSE 'bad_answer' END, NULL FROM conversations WHERE role = 'assistant'""",
}
