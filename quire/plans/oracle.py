"""DuckDB SQL equivalents of the registered queries (the correctness oracle).
Built from small CTE templates so each query reads the same tables."""

from __future__ import annotations

BLOCK = 256
CP_BOS, CP_EOS = 1114112, 1114113

LINES = """lines AS (
  SELECT source, doc_id, CAST(pos AS BIGINT) AS pos, line AS text FROM (
    SELECT source, doc_id, unnest(range(len(p))) AS pos, unnest(p) AS line
    FROM (SELECT source, doc_id, string_split(text, chr(10)) AS p FROM documents)))"""

CP_TOKS = f"""toks AS (
  SELECT source, doc_id,
         list_concat([{CP_BOS}], CASE WHEN length(text) > 0
                THEN list_transform(string_split(text, ''), lambda c: unicode(c))
                ELSE CAST([] AS INTEGER[]) END, [{CP_EOS}]) AS ids
  FROM documents)"""


def pack_ctes(src: str = "toks", block: int = BLOCK, keep: str = "reference",
              keys: str = "source", order: str = "doc_id") -> str:
    cond = {"reference": f"n = {block} OR block_id = 0", "drop": f"n = {block}", "keep": "TRUE"}[keep]
    return f"""offs AS (
  SELECT {keys}, {order}, ids,
         CAST(coalesce(sum(len(ids)) OVER (PARTITION BY {keys} ORDER BY {order}
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off
  FROM {src}),
flat AS (
  SELECT {keys}, off + pos AS g, tok FROM (
    SELECT {keys}, off, unnest(range(len(ids))) AS pos, unnest(ids) AS tok FROM offs)),
allblocks AS (
  SELECT {keys}, CAST(g // {block} AS BIGINT) AS block_id, count(*) AS n,
         list(tok ORDER BY g) AS toks
  FROM flat GROUP BY {keys}, g // {block}),
blocks AS (SELECT * FROM allblocks WHERE {cond})"""


def cp_ids(text: str = "text") -> str:
    return (f"list_concat([{CP_BOS}], CASE WHEN length({text}) > 0 THEN list_transform(string_split({text}, ''), "
            f"lambda c: unicode(c)) ELSE CAST([] AS INTEGER[]) END, [{CP_EOS}])")


def ids_text(col: str) -> str:
    return f"array_to_string({col}, ',')"


SQL = {}

SQL["scan_lines"] = f"WITH {LINES} SELECT source, doc_id, pos, text FROM lines"

SQL["line_numbers"] = f"""WITH {LINES}
SELECT source, doc_id, pos,
       CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) - 1 AS BIGINT) AS line_no
FROM lines"""

SQL["tokenise_codepoint"] = f"""WITH {CP_TOKS}
SELECT source, doc_id, CAST(len(ids) AS BIGINT) AS n_tokens, {ids_text('ids')} AS ids FROM toks"""

SQL["pack_global"] = f"""WITH {CP_TOKS}, {pack_ctes()}
SELECT source, block_id, CAST(n AS BIGINT) AS n_tokens, {ids_text('toks')} AS ids FROM blocks"""

SQL["pack_accounting"] = f"""WITH {CP_TOKS}, {pack_ctes()},
tin AS (SELECT source, CAST(sum(len(ids)) AS BIGINT) AS tokens_in FROM toks GROUP BY source),
kept AS (SELECT source, CAST(sum(n) AS BIGINT) AS tokens_kept, count(*) AS n_blocks FROM blocks GROUP BY source)
SELECT tin.source, tokens_in, coalesce(tokens_kept, 0) AS tokens_kept,
       tokens_in - coalesce(tokens_kept, 0) AS tokens_dropped, coalesce(n_blocks, 0) AS n_blocks
FROM tin LEFT JOIN kept USING (source)"""

SEED = 42
FRAC = 0.05
CAP = 100
BATCH, ACCUM = 12, 8

SQL["pack_batch"] = f"""WITH {LINES},
lt AS (SELECT source, doc_id, pos, {cp_ids()} AS ids FROM lines),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) - 1 AS i,
             count(*) OVER (PARTITION BY source) AS n FROM lt),
s1 AS (SELECT *, n // least(8, n) AS q, n % least(8, n) AS m FROM r),
s2 AS (SELECT *, CASE WHEN i < m * (q + 1) THEN i // (q + 1) ELSE m + (i - m * (q + 1)) // q END AS shard FROM s1),
s3 AS (SELECT *, (i - CASE WHEN shard < m THEN shard * (q + 1) ELSE m * (q + 1) + (shard - m) * q END) // 1000 AS bt
       FROM s2),
offs AS (SELECT source, shard, bt, ids,
                coalesce(sum(len(ids)) OVER (PARTITION BY source, shard, bt ORDER BY doc_id, pos
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM s3),
flat AS (SELECT source, shard, bt, off + p AS g, tok FROM (
           SELECT source, shard, bt, off, unnest(range(len(ids))) AS p, unnest(ids) AS tok FROM offs)),
lb AS (SELECT source, shard, bt, g // {BLOCK} AS b, count(*) AS n, list(tok ORDER BY g) AS toks
       FROM flat GROUP BY source, shard, bt, g // {BLOCK}),
kept AS (SELECT * FROM lb WHERE n = {BLOCK} OR b = 0)
SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY shard, bt, b) - 1 AS BIGINT) AS block_id,
       CAST(n AS BIGINT) AS n_tokens, array_to_string(toks, ',') AS ids FROM kept"""

SQL["pack_pad"] = f"""WITH {CP_TOKS}, {pack_ctes(keep="keep")}
SELECT source, block_id, CAST(n AS BIGINT) AS n_real,
       array_to_string(toks, ',') || repeat(',0', {BLOCK} - n) AS ids,
       array_to_string(toks, ',') || repeat(',-100', {BLOCK} - n) AS labels
FROM blocks"""

SQL["concat_sources"] = f"""WITH toks AS (SELECT lang, source, doc_id, {cp_ids()} AS ids FROM documents),
{pack_ctes(keys="lang, source")}
SELECT lang AS part, source, block_id,
       CAST(row_number() OVER (ORDER BY lang, source, block_id) - 1 AS BIGINT) AS row_idx,
       CAST(n AS BIGINT) AS n_tokens
FROM blocks"""

SPLIT_RANKED = f"""ranked AS (
  SELECT source, block_id, toks,
         row_number() OVER (ORDER BY md5('{SEED}:' || source || ':' || block_id), source, block_id) AS rn,
         count(*) OVER () AS nb
  FROM blocks)"""

SQL["split_test"] = f"""WITH {CP_TOKS}, {pack_ctes()}, {SPLIT_RANKED}
SELECT source, block_id FROM ranked WHERE rn <= ceil(CAST({FRAC} AS DOUBLE) * nb)"""

SQL["split_train"] = f"""WITH {CP_TOKS}, {pack_ctes()}, {SPLIT_RANKED}
SELECT source, block_id FROM ranked WHERE rn > ceil(CAST({FRAC} AS DOUBLE) * nb)"""

SQL["cap_rows"] = f"""WITH {CP_TOKS}, {pack_ctes()}, {SPLIT_RANKED}
SELECT source, block_id FROM ranked
WHERE rn > ceil(CAST({FRAC} AS DOUBLE) * nb) AND rn <= ceil(CAST({FRAC} AS DOUBLE) * nb) + {CAP}"""


def _mix_sql(size: str) -> str:
    agg = "count(*)" if size == "1" else f"sum({size})"
    return f"""WITH d AS (SELECT doc_id, n_chars, CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS grp FROM documents),
w AS (SELECT * FROM (VALUES ('other', 3), ('en', 4)) t(grp, wt)),
sw AS (SELECT grp, CAST({agg} AS BIGINT) AS s, any_value(wt) AS wt FROM d JOIN w USING (grp) GROUP BY grp),
lim AS (SELECT s AS sh, wt AS wh FROM sw ORDER BY CAST(s AS DOUBLE) / wt, grp LIMIT 1),
t AS (SELECT grp, (wt * sh) // wh AS target FROM sw, lim),
r AS (SELECT doc_id, grp, sum({size}) OVER (PARTITION BY grp ORDER BY md5('{SEED}:' || doc_id), doc_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM d)
SELECT doc_id, grp FROM r JOIN t USING (grp) WHERE run <= target"""


SQL["mix_rows"] = _mix_sql("1")
SQL["mix_tokens"] = _mix_sql("n_chars")

BATCHED = """numbered AS (
  SELECT *, row_number() OVER (ORDER BY source, block_id) - 1 AS idx FROM blocks),
grouped AS (
  SELECT CAST(idx // {batch} AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS rows,
         min(n) <> max(n) AS ragged,
         string_agg(array_to_string(toks, ','), ';' ORDER BY idx) AS ids,
         arg_min(array_to_string(toks, ','), idx) AS first_ids
  FROM numbered GROUP BY idx // {batch})"""

SQL["batch_rows"] = f"""WITH {CP_TOKS}, {pack_ctes()}, {BATCHED.format(batch=BATCH)}
SELECT batch_id, rows, ragged, ids FROM grouped"""

SQL["batch_ragged"] = f"""WITH {CP_TOKS}, {pack_ctes(keep="keep")}, {BATCHED.format(batch=BATCH)}
SELECT batch_id, rows, ragged,
       CASE WHEN ragged THEN repeat(first_ids || ';', rows - 1) || first_ids ELSE ids END AS ids
FROM grouped"""

SQL["step_report"] = f"""WITH {CP_TOKS}, {pack_ctes()}
SELECT count(*) AS n_blocks, CAST({BATCH * ACCUM} AS BIGINT) AS rows_per_step,
       CAST({BATCH * ACCUM * BLOCK} AS BIGINT) AS tokens_per_step,
       CAST(ceil(count(*) / {BATCH * ACCUM}) AS BIGINT) AS steps, CAST(count(*) * {BLOCK} AS BIGINT) AS tokens
FROM blocks"""

SQL["export_shards"] = """SELECT vec_id,
       CAST(CASE WHEN n // 3 = 0 THEN 2 ELSE least((rn - 1) // (n // 3), 2) END AS INTEGER) AS shard
FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rn, count(*) OVER () AS n FROM embeddings)"""

SQL["batch_labels"] = """WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id) - 1 AS i FROM (
    SELECT doc_id, n_chars, quality, toxic, CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS part FROM documents JOIN labels USING (doc_id)))
SELECT part, CAST(i // 12 AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS rows, false AS ragged,
       string_agg(quality::VARCHAR, ',' ORDER BY i) AS labels, string_agg(n_chars::VARCHAR, ',' ORDER BY i) AS sizes,
       string_agg(n_chars || ':' || doc_id, ',' ORDER BY i) AS pairs,
       CASE WHEN part = 'en' THEN string_agg(toxic::VARCHAR, ',' ORDER BY i) END AS maybe
FROM placed GROUP BY part, i // 12"""

SQL["batch_label_ids"] = """WITH placed AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents JOIN labels USING (doc_id)),
made AS (
  SELECT i // 12 AS b, count(*) AS n, min(toxic) <> max(toxic) AS ragged,
         string_agg(quality || ':' || toxic, ',' ORDER BY i) AS labels, arg_min(n_chars, i) AS n0, arg_min(doc_id, i) AS d0, arg_min(toxic, i) AS t0,
         string_agg(CASE toxic WHEN 1 THEN doc_id || ':' || doc_id ELSE doc_id::VARCHAR END, ',' ORDER BY i) AS ids,
         string_agg(n_chars::VARCHAR, ',' ORDER BY i) AS sizes
  FROM placed GROUP BY i // 12)
SELECT CAST(b AS BIGINT) AS batch_id, CAST(n AS INTEGER) AS rows, ragged, labels,
       CASE WHEN ragged THEN array_to_string(list_transform(range(n), lambda k: CASE t0 WHEN 1 THEN d0 || ':' || d0 ELSE d0::VARCHAR END), ',')
            ELSE ids END AS ids,
       CASE WHEN ragged THEN array_to_string(list_transform(range(n), lambda k: n0::VARCHAR), ',') ELSE sizes END AS sizes
FROM made"""

WS = (r"\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}"
      r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")


def strip(col: str) -> str:
    return f"regexp_replace({col}, '\\A[{WS}]+|[{WS}]+\\z', '', 'g')"


SQL["cache_manifest"] = f"""WITH {LINES},
sized AS (SELECT source, CAST(sum(length(text) + 2) AS BIGINT) AS n FROM lines GROUP BY source)
SELECT source, {BLOCK} AS block_size, 'codepoint-v1' AS tokenizer_fp,
       CASE WHEN n < {BLOCK} THEN 1 ELSE n // {BLOCK} END AS rows FROM sized"""

SQL["first_source"] = """SELECT doc_id, source FROM documents WHERE source = (SELECT min(source) FROM documents)"""

SQL["source_keys"] = """WITH names AS (
  SELECT DISTINCT regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1) AS name FROM pages),
keyed AS (SELECT name, array_to_string(list_slice(string_split(name, '.'), 1, len(string_split(name, '.')) - 1), '') AS key
          FROM names)
SELECT name, key, count(*) OVER (PARTITION BY key) AS n_names FROM keyed"""

QLINES = """qlines AS (
  SELECT item_id, CAST(pos AS BIGINT) AS pos, line FROM (
    SELECT item_id, unnest(range(len(p))) AS pos, unnest(p) AS line
    FROM (SELECT item_id, string_split(text, chr(10)) AS p FROM benchmark)))"""

SQL["questions"] = f"WITH {QLINES} SELECT item_id, pos, {strip('line')} AS question FROM qlines"

SQL["preview"] = f"""WITH {QLINES} SELECT item_id, pos, {strip('line')} AS question FROM qlines
ORDER BY item_id, pos LIMIT 10"""

SQL["strip_text"] = f"WITH {LINES} SELECT doc_id, pos, {strip('text')} AS text FROM lines"

SQL["decode_unigram"] = f"SELECT doc_id, regexp_replace(regexp_replace(text, '[{WS}]+', ' ', 'g'), ' \\z', '') AS text FROM documents"

SQL["nonblank"] = f"WITH {LINES} SELECT doc_id, pos FROM lines WHERE length({strip('text')}) > 0"

WORD_SEP = r"[ \t\n\r\x{0b}\x{0c}]+"


def words_of(table: str, key: str, where: str = "TRUE") -> str:
    return f"""SELECT {key}, list_filter(regexp_split_to_array(text, '{WORD_SEP}'), lambda w: w <> '') AS ws
  FROM {table} WHERE {where}"""


def vocab_cte(name: str, table: str, size: int, where: str = "TRUE") -> str:
    return f"""{name}_w AS ({words_of(table, 'NULL AS k', where)}),
{name}_c AS (SELECT w AS piece, count(*) AS c FROM (SELECT unnest(ws) AS w FROM {name}_w) GROUP BY w),
{name} AS (
  SELECT * FROM (VALUES (0, '<unk>', 0.0), (1, '<s>', 0.0), (2, '</s>', 0.0)) t(id, piece, score)
  UNION ALL
  SELECT CAST(row_number() OVER (ORDER BY c DESC, piece) + 2 AS INTEGER) AS id, piece, CAST(c AS DOUBLE) AS score
  FROM {name}_c QUALIFY row_number() OVER (ORDER BY c DESC, piece) <= {size - 3})"""


DOC_WORDS = f"""dw AS ({words_of('documents', 'doc_id, source, lang')}),
dflat AS (SELECT doc_id, p, w FROM (SELECT doc_id, unnest(range(len(ws))) AS p, unnest(ws) AS w FROM dw))"""

SQL["tokenise_word"] = f"""WITH {vocab_cte('vocab', 'documents', 5000)}, {DOC_WORDS},
mapped AS (SELECT doc_id, p, coalesce(v.id, 0) AS id FROM dflat LEFT JOIN vocab v ON dflat.w = v.piece),
agg AS (SELECT doc_id, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY p) AS s FROM mapped GROUP BY doc_id)
SELECT dw.doc_id, dw.source, CAST(coalesce(n, 0) + 2 AS BIGINT) AS n_tokens, '1' || coalesce(',' || s, '') || ',2' AS ids
FROM dw LEFT JOIN agg USING (doc_id)"""

SQL["decode_roundtrip"] = """SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n_chars FROM documents"""

SQL["decode_words"] = f"""WITH {vocab_cte('vocab', 'documents', 5000)}, {DOC_WORDS},
mapped AS (SELECT doc_id, p, coalesce(v.piece, '<unk>') AS piece FROM dflat LEFT JOIN vocab v ON dflat.w = v.piece),
agg AS (SELECT doc_id, string_agg(piece, ' ' ORDER BY p) AS s FROM mapped GROUP BY doc_id)
SELECT dw.doc_id, coalesce(s, '') AS text FROM dw LEFT JOIN agg USING (doc_id)"""

SQL["overlong"] = f"""WITH {CP_TOKS}
SELECT source, count(*) AS n_inputs, count(*) FILTER (WHERE len(ids) > 4096) AS n_overlong,
       CAST(max(len(ids)) AS BIGINT) AS max_len FROM toks GROUP BY source"""

EXTENDED = f"""{vocab_cte('base', 'documents', 3000, "lang = 'en'")},
{vocab_cte('new', 'documents', 3000, "lang <> 'en'")},
added AS (SELECT n.id AS nid, n.piece FROM new n ANTI JOIN base b ON n.piece = b.piece),
ext AS (
  SELECT id, piece FROM base
  UNION ALL
  SELECT CAST((SELECT max(id) + 1 FROM base) + row_number() OVER (ORDER BY nid) - 1 AS INTEGER) AS id, piece FROM added)"""

SQL["extend_vocab"] = f"WITH {EXTENDED} SELECT id, piece FROM ext"

SQL["check_vocab"] = f"""WITH {EXTENDED}
SELECT count(*) AS n_entries, count(DISTINCT id) AS n_ids, count(DISTINCT piece) AS n_pieces,
       CAST(max(id) + 1 AS BIGINT) AS id_span, CAST(56724 AS BIGINT) AS expected,
       count(*) = 56724 AND count(DISTINCT id) = 56724 AND count(DISTINCT piece) = 56724 AND max(id) + 1 = 56724 AS ok
FROM ext"""

SQL["length_reduction"] = f"""WITH dw AS ({words_of('documents', 'doc_id, lang, text AS t')})
SELECT lang, CAST(sum(length(t)) AS BIGINT) AS tokens_a, CAST(sum(len(ws)) AS BIGINT) AS tokens_b,
       round(1 - sum(len(ws)) / sum(length(t)), 6) AS reduction
FROM dw GROUP BY ROLLUP (lang)"""

SQL["token_lookup"] = f"""WITH {vocab_cte('vocab', 'documents', 5000)},
bw AS (SELECT DISTINCT unnest(ws) AS piece FROM ({words_of('benchmark', 'item_id')}))
SELECT bw.piece, CAST(coalesce(v.id, 0) AS INTEGER) AS id FROM bw LEFT JOIN vocab v ON bw.piece = v.piece"""

SQL["drop_special"] = f"""WITH {vocab_cte('vocab', 'documents', 5000)},
bw AS ({words_of('benchmark', 'item_id')}),
bflat AS (SELECT item_id, p, w FROM (SELECT item_id, unnest(range(len(ws))) AS p, unnest(ws) AS w FROM bw)),
mapped AS (SELECT item_id, p, coalesce(v.id, 0) AS id FROM bflat LEFT JOIN vocab v ON bflat.w = v.piece)
SELECT bw.item_id, coalesce((SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY p) FROM mapped m
                             WHERE m.item_id = bw.item_id AND id NOT IN (1, 2)), '') AS ids
FROM bw"""

SCORED = f"""{CP_TOKS}, {pack_ctes()}, {SPLIT_RANKED},
parts AS (SELECT source, toks, CASE WHEN rn <= ceil(CAST({FRAC} AS DOUBLE) * nb) THEN 'test' ELSE 'train' END AS split
          FROM ranked),
pr AS (SELECT split, source, toks[i] AS a, toks[i + 1] AS b
       FROM (SELECT split, source, toks, unnest(range(1, len(toks))) AS i FROM parts)),
cab AS (SELECT a, b, count(*) AS c FROM pr WHERE split = 'train' GROUP BY a, b),
model AS (SELECT a, sum(c) AS n_a, arg_max(b, c * 1000000000 - b) AS pred FROM cab GROUP BY a),
vsize AS (SELECT count(DISTINCT t) AS v FROM (SELECT unnest(toks) AS t FROM parts WHERE split = 'train')),
mt AS (SELECT source, a, b, count(*) AS m FROM pr WHERE split = 'test' GROUP BY source, a, b),
scored AS (
  SELECT mt.source, mt.a, mt.b, mt.m,
         -ln((coalesce(cab.c, 0) + 1.0) / (coalesce(model.n_a, 0) + 1.0 * (SELECT v FROM vsize))) AS nll,
         coalesce(model.pred = mt.b, false) AS hit
  FROM mt LEFT JOIN cab ON mt.a = cab.a AND mt.b = cab.b LEFT JOIN model ON mt.a = model.a)"""

SQL["bigram_nll"] = f"""WITH {SCORED}
SELECT source, CAST(sum(m) AS BIGINT) AS tokens, round(sum(m * nll) / sum(m), 6) AS nll FROM scored GROUP BY source"""

SQL["token_accuracy"] = f"""WITH {SCORED}
SELECT CAST(sum(m) AS BIGINT) AS tokens, round(sum(CASE WHEN hit THEN m ELSE 0 END) / sum(m), 6) AS accuracy FROM scored"""

SQL["perplexity"] = f"""WITH {SCORED}
SELECT CAST(sum(m) AS BIGINT) AS tokens, round(sum(m * nll) / sum(m), 6) AS eval_loss,
       round(exp(sum(m * nll) / sum(m)), 4) AS perplexity FROM scored"""

SQL["metric_rollup"] = f"""WITH {SCORED}
SELECT source, CAST(sum(m) AS BIGINT) AS tokens,
       round(sum(CASE WHEN hit THEN m ELSE 0 END) / sum(m), 6) AS accuracy,
       round(exp(sum(m * nll) / sum(m)), 4) AS perplexity
FROM scored GROUP BY ROLLUP (source)"""

LABELLED = """lab AS (SELECT l.doc_id, l.quality AS pred, 1 - l.toxic AS ref, d.n_chars
                FROM labels l JOIN documents d USING (doc_id))"""

SQL["accuracy_count"] = f"""WITH {LABELLED}
SELECT count(*) AS n, CAST(count(*) FILTER (WHERE pred = ref) AS DOUBLE) AS accuracy FROM lab"""

SQL["accuracy_weighted"] = f"""WITH {LABELLED}
SELECT count(*) AS n, round(sum(CASE WHEN pred = ref THEN CAST(n_chars AS DOUBLE) ELSE 0.0 END)
                            / sum(CAST(n_chars AS DOUBLE)), 6) AS accuracy FROM lab"""

SQL["sample_counts"] = f"""WITH {CP_TOKS}, {pack_ctes()}, {SPLIT_RANKED}
SELECT 'train' AS phase, count(*) AS samples FROM ranked WHERE rn > ceil(CAST({FRAC} AS DOUBLE) * nb)
UNION ALL
SELECT 'eval' AS phase, least(100, count(*)) AS samples FROM ranked WHERE rn <= ceil(CAST({FRAC} AS DOUBLE) * nb)"""

SQL["argmax"] = """SELECT vec_id, CAST(CASE WHEN len(embedding) > 0 THEN list_position(embedding, list_max(embedding)) - 1 END AS INTEGER) AS argmax
FROM embeddings"""

SQL["label_typing"] = """SELECT 'quality' AS "column", count(quality) AS n,
       count(*) FILTER (WHERE CAST(quality AS DOUBLE) <> floor(CAST(quality AS DOUBLE))) AS n_fractional,
       CASE WHEN count(*) FILTER (WHERE CAST(quality AS DOUBLE) <> floor(CAST(quality AS DOUBLE))) = 0 THEN 'bigint' ELSE 'double' END AS target_type
FROM labels
UNION ALL
SELECT 'toxic', count(toxic), count(*) FILTER (WHERE CAST(toxic AS DOUBLE) <> floor(CAST(toxic AS DOUBLE))),
       CASE WHEN count(*) FILTER (WHERE CAST(toxic AS DOUBLE) <> floor(CAST(toxic AS DOUBLE))) = 0 THEN 'bigint' ELSE 'double' END
FROM labels
UNION ALL
SELECT 'value', count(value), count(*) FILTER (WHERE value <> floor(value)),
       CASE WHEN count(*) FILTER (WHERE value <> floor(value)) = 0 THEN 'bigint' ELSE 'double' END
FROM events"""

SQL["vector_bytes"] = """SELECT label, count(*) AS n_vectors, CAST(sum(len(embedding)) AS BIGINT) AS n_elements,
       CAST(sum(len(embedding)) * 4 AS BIGINT) AS bytes
FROM embeddings GROUP BY ROLLUP (label)"""

SYSTEM_PROMPT = "You are a helpful assistant. 你是一个乐于助人的助手。"
SYS_HEAD, SYS_TAIL = "<|start_header_id|>system<|end_header_id|>\n\n", "<|eot_id|>"
USER_HEAD = "<|start_header_id|>user<|end_header_id|>\n\n"
USER_TAIL = "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
ASSIST_TAIL = "<|eot_id|>"


def prompt_sql(col: str) -> str:
    return f"'{SYS_HEAD}{SYSTEM_PROMPT}{SYS_TAIL}{USER_HEAD}' || {col} || '{USER_TAIL}'"


CHAT = f"""rendered AS (
  SELECT conv_id, turn, CASE role
      WHEN 'system' THEN '{SYS_HEAD}' || text || '{SYS_TAIL}'
      WHEN 'user' THEN '{USER_HEAD}' || text || '{USER_TAIL}'
      WHEN 'assistant' THEN text || '{ASSIST_TAIL}' END AS t
  FROM conversations),
chat AS (SELECT conv_id, string_agg(t, '' ORDER BY turn) AS text FROM rendered GROUP BY conv_id),
plain AS (SELECT conv_id, regexp_replace(text, '<\\|start_header_id\\|>|<\\|end_header_id\\|>|<\\|eot_id\\|>|<\\|end_of_text\\|>|<\\|begin_of_text\\|>', '', 'g') AS text
          FROM chat)"""

MARK = "assistant\n\n"

SQL["render_prompt"] = f"""WITH {QLINES} SELECT item_id, pos, {prompt_sql(strip('line'))} AS prompt FROM qlines"""

SQL["render_chat"] = f"WITH {CHAT} SELECT conv_id, text FROM chat"

SQL["answer_second"] = f"""WITH {CHAT} SELECT conv_id, {strip(f"string_split(text, '{MARK}')[2]")} AS answer FROM plain"""

SQL["answer_last"] = f"""WITH {CHAT} SELECT conv_id, {strip(f"string_split(text, '{MARK}')[-1]")} AS answer FROM plain"""

SQL["cut_at_stop"] = f"""WITH {CHAT}
SELECT conv_id, split_part(split_part(text, '<|eot_id|>', 1), '<|end_of_text|>', 1) AS text FROM chat"""

PAIRS = """pairs AS (
  SELECT conv_id, turn, question, answer FROM (
    SELECT conv_id, turn, role, text AS question, lead(role) OVER w AS next_role, lead(text) OVER w AS answer
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

SQL["turn_pairs"] = f"WITH {PAIRS} SELECT conv_id, turn, question, answer FROM pairs"

SQL["prediction_record"] = f"""WITH {PAIRS}
SELECT CAST(row_number() OVER (ORDER BY conv_id, turn) - 1 AS BIGINT) AS idx,
       {prompt_sql('question')} AS "Input", answer AS "Output" FROM pairs"""

PATCH = """patch AS (
  SELECT vec_id, list_transform(embedding, lambda x: x * 2) AS embedding, label FROM embeddings WHERE label = 3
  UNION ALL
  SELECT vec_id + 1000000, embedding, label FROM embeddings WHERE label = 4)"""


def exploded_sql(src: str, col: str = "embedding") -> str:
    return f"""SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(CAST(v AS DOUBLE), 6) AS value FROM (
  SELECT vec_id, unnest(range(len({col}))) AS pos, unnest({col}) AS v FROM {src})"""


SQL["override"] = f"""WITH {PATCH},
merged AS (SELECT e.vec_id, coalesce(p.embedding, e.embedding) AS embedding FROM embeddings e LEFT JOIN patch p USING (vec_id))
{exploded_sql('merged')}"""

SQL["override_fields"] = f"""WITH {PATCH}
SELECT e.vec_id, CASE WHEN p.vec_id IS NOT NULL THEN p.label ELSE e.label + 100 END AS label,
       round(CAST((CASE WHEN p.vec_id IS NOT NULL THEN p.embedding ELSE e.embedding END)[1] AS DOUBLE), 6) AS e0
FROM embeddings e LEFT JOIN patch p USING (vec_id)"""

SQL["last_wins"] = """WITH parts AS (
  SELECT 'L' || CAST(hour(ts) AS VARCHAR) || '-part.00' AS part, 'user' || CAST(user_id AS VARCHAR) AS key,
         count(*) AS value
  FROM events GROUP BY 1, 2)
SELECT key, max(part) AS part, arg_max(value, part) AS value FROM parts GROUP BY key"""

SQL["low_rank_r1"] = f"""WITH a AS (
  SELECT pos, avg(CAST(v AS DOUBLE)) AS m FROM (
    SELECT unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings WHERE label = 0)
  GROUP BY pos),
x AS (SELECT vec_id, pos, CAST(v AS DOUBLE) AS v FROM (
  SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings)),
dot AS (SELECT x.vec_id, sum(x.v * a.m) AS d FROM x JOIN a USING (pos) GROUP BY x.vec_id)
SELECT x.vec_id, CAST(x.pos AS INTEGER) AS pos, round(x.v + 2.0 * a.m * dot.d, 6) AS value
FROM x JOIN a USING (pos) JOIN dot USING (vec_id)"""

SQL["name_filter"] = """SELECT page_id, url FROM pages WHERE regexp_matches(url, '^(?:https?://m\\.)')"""

SQL["low_rank"] = """WITH e AS (
  SELECT vec_id, label, unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
a AS (SELECT label, pos, avg(v) AS m FROM e WHERE label IN (0, 1, 2, 3) GROUP BY label, pos),
dot AS (SELECT vec_id, a.label, sum(v * m) AS d FROM e JOIN a USING (pos) GROUP BY vec_id, a.label),
upd AS (SELECT vec_id, pos, sum(m * d) AS u FROM dot JOIN a USING (label) GROUP BY vec_id, pos)
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(v + 2.0 / 4 * u, 6) AS value FROM e JOIN upd USING (vec_id, pos)"""

# the stub model's answer: the words of the question in reverse order
REVERSED = r"array_to_string(list_reverse(list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> '')), ' ')"

SQL["batch_generate"] = f"""SELECT row_number() OVER (ORDER BY item_id, pos) - 1 AS idx, question AS "Input",
  {REVERSED.format('question')} AS "Output" FROM ({SQL['questions']})"""
