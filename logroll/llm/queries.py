"""Registered queries of this subpackage and their SQL.  Every query reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logroll.llm.common import table

QUERIES, SQL = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.near_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85, k=5)


# Every pair of documents that share a shingle is compared on full sets; closure by recursion.
SQL["op1_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w WHERE ws IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * p.i >= 85 * (x.n + y.n - p.i)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       CAST(least(d.doc_id, coalesce(m.c, d.doc_id)) AS BIGINT) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.c, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = d.doc_id"""


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.substring_dup import remove_repeats
    return (remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


@query
def op6_byte_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.sharding import shard_by_bytes
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)


@query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from logroll.llm.chat import digest, format_chats, text_part
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT CAST(-1 AS BIGINT) AS conv_id, t AS turn, r AS role, '</s>[INST] ok [/INST]' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    return digest(format_chats(rows.union(probe).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))))


SQL["op9_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
e AS (
  SELECT *, replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), chr(10), '&nl;') AS er,
         replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;') AS et FROM t),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
         CAST(sum(length(er) + length(et) + 17) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
       CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM c"""


@query
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.topk import top_inner_products
    return top_inner_products(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


SQL["op7_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op10_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.mixing import taken
    return taken(table(spark, sf_dir, "documents"))


@query
def op4_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from logroll.llm.packing import pack
    docs = table(spark, sf_dir, "documents")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False).drop("ids")


@query
def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.pii import replace_personal_data
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return replace_personal_data(docs)


@query
def op8_co_training_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.manifest import audit_rows
    return audit_rows(table(spark, sf_dir, "documents"))


# Levels by recursion over (group, level, index); then every leaf walks up to its group's root and on.
SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE c AS (
  SELECT *, list_reduce(list_concat([4294967295::UBIGINT], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda x: [ascii(x) + 1, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]))),
    lambda a, x: CASE WHEN x > 0 THEN xor(a, (x - 1)::UBIGINT)
                      ELSE xor(a >> 1, (3988292384 * (a & 1))::UBIGINT) END) AS crc
  FROM documents),
e AS (
  SELECT *, CASE WHEN n_chars IS NULL OR doc_id IS NULL OR xor(crc, 4294967295::UBIGINT) % 7 <> 0 THEN n_chars
                 ELSE n_chars + 1 END AS tampered_chars,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS x,
         coalesce(strlen(text) || ':' || text, '-') AS z FROM c),
l AS (
  SELECT doc_id, sha256(x || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || z) AS leaf,
         sha256(x || coalesce(strlen(CAST(tampered_chars AS VARCHAR)) || ':' || tampered_chars, '-') || z) AS tampered,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx FROM e),
t(g, lvl, idx, n, h) AS (
  SELECT g, 0, idx, n, leaf FROM l
  UNION ALL
  SELECT a.g, a.lvl + 1, a.idx // 2, (a.n + 1) // 2, sha256(a.h || coalesce(b.h, ''))
  FROM t a LEFT JOIN t b ON b.g = a.g AND b.idx = a.idx + 1 WHERE a.idx % 2 = 0 AND a.n > 1),
s AS (SELECT g, h, count(*) OVER () AS m FROM t WHERE n = 1),
u(g, lvl, idx, n, h) AS (
  SELECT -1, 0, g, m, h FROM s
  UNION ALL
  SELECT -1, a.lvl + 1, a.idx // 2, (a.n + 1) // 2, sha256(a.h || coalesce(b.h, ''))
  FROM u a LEFT JOIN u b ON b.idx = a.idx + 1 WHERE a.idx % 2 = 0 AND a.n > 1),
v AS (SELECT * FROM t UNION ALL SELECT * FROM u),
w(doc_id, leaf, top, m, g, lvl, idx, n, path, f) AS (
  SELECT doc_id, leaf, l.g, m, l.g, 0, idx, n, '', tampered FROM l JOIN s ON s.g = l.g
  UNION ALL
  SELECT w.doc_id, w.leaf, w.top, w.m, CASE WHEN w.n > 1 THEN w.g ELSE -1 END, CASE WHEN w.n > 1 THEN w.lvl + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN w.idx // 2 ELSE w.g END, CASE WHEN w.n > 1 THEN (w.n + 1) // 2 ELSE w.m END,
         w.path || coalesce(v.h, ''),
         CASE WHEN w.n = 1 THEN w.f WHEN w.idx % 2 = 0 THEN sha256(w.f || coalesce(v.h, '')) ELSE sha256(v.h || w.f) END
  FROM w LEFT JOIN v ON w.n > 1 AND v.g = w.g AND v.lvl = w.lvl AND v.idx = xor(w.idx, 1)
  WHERE NOT (w.g = -1 AND w.n = 1))
SELECT w.doc_id, w.leaf, s.h AS subroot, r.h AS root, sha256(w.path) AS proof_sha256, w.f AS folded_root, w.f = r.h AS verified
FROM w JOIN s ON s.g = w.top CROSS JOIN (SELECT h FROM u WHERE n = 1) r WHERE w.g = -1 AND w.n = 1"""


@query
def op12_token_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from logroll.llm.token_store import stored_ids
    from logroll.session import scratch_dir
    docs = table(spark, sf_dir, "documents")
    return stored_ids(docs, scratch_dir(spark, "llm-token-store") + "/store", public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from logroll.llm.filter_audit import filter_interactions
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Every order is applied to every document.
SQL["op13_filter_interactions"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
f AS (
  SELECT d.part,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM d JOIN m USING (t)),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS x, filter_order[1:step - 1] AS earlier
      FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, x,
         count(*) FILTER (WHERE translate(fails, earlier || x, '') = fails) AS kept,
         count(*) FILTER (WHERE contains(fails, x) AND translate(fails, earlier, '') = fails) AS removed,
         count(*) FILTER (WHERE contains(fails, x) AND translate(fails, earlier, '') <> fails) AS redundant,
         count(*) FILTER (WHERE fails = x) AS unique_fails,
         count(*) FILTER (WHERE contains(fails, x) AND translate(fails, earlier, '') = fails AND good) AS good_lost,
         count(*) FILTER (WHERE contains(fails, x) AND translate(fails, earlier, '') = fails AND toxic) AS toxic_lost
  FROM f, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM r"""
