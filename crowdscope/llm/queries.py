"""Registered queries of the llm operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdscope.llm.common import table
from crowdscope.registry import register

#: A public tokenizer's file, present on every executor.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

SQL_CAPTURES = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, 1704067200 + page_id AS captured_at,
         regexp_replace(coalesce(url, ''), '#.*$', '') AS u
  FROM pages),
k AS (
  SELECT page_id, html, captured_at,
         array_to_string(list_reverse(string_split(lower(regexp_extract(u, '^[a-z]+://([^/?]*)', 1)), '.')), ',')
         || ')' || regexp_replace(u, '^[a-z]+://[^/?]*', '') AS url_key
  FROM p),
d AS (
  SELECT *, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
         min(page_id) OVER (PARTITION BY sha256(html)) AS first_page
  FROM k)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to,
       url_key, captured_at,
       row_number() OVER (ORDER BY url_key, captured_at, page_id) - 1 AS capture_no
FROM d"""


@register("op1_warc_history", SQL_CAPTURES)
def op1_warc_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.warc import capture_history
    pages = table(spark, sf_dir, "pages")
    # the table has no capture time: one page a second from 2024 on
    return capture_history(pages, F.lit(1704067200) + F.coalesce(F.col("page_id"), F.lit(0))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "capture_no")


@register("op2_vector_shards")
def op2_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.shards import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens")


@register("op6_complement_packing")
def op6_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), BYTE_BPE, 2048)


SQL_BENCHMARK = r"""
WITH b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS gram
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
g AS (
  SELECT r, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS gram
  FROM d, (SELECT DISTINCT k FROM bw) AS ks, unnest(range(1, len(w) - k + 2)) AS t(p)),
h AS (SELECT g.r, g.k, g.p, bw.item FROM g JOIN bw ON g.k = bw.k AND g.gram = bw.gram),
n AS (SELECT r, count(DISTINCT q) AS n_hit FROM h, unnest(range(p, p + k)) AS t(q) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r)"""


@register("op10_decontaminate", SQL_BENCHMARK)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.decontam import find_benchmark
    docs = table(spark, sf_dir, "documents")
    hits, name = find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return hits.select("doc_id", f"{name}.n_words", f"{name}.n_hit",
                       F.size(f"{name}.items").cast("long").alias("n_items"),
                       F.sha2(F.array_join(f"{name}.items", ","), 256).alias("items_sha256"),
                       (F.col(f"{name}.n_hit") > 0).alias("contaminated"))


def held_out(parts: int, remainder: int):
    """Whether a document is outside the rows that may be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == remainder, F.lit(False))


@register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.toxicity import fit, score
    docs = table(spark, sf_dir, "documents")
    out, name = score(docs, fit(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1)), ["doc_id"])
    return out.select("doc_id", held_out(3, 1).alias("held_out"), f"{name}.score", f"{name}.predicted")


@register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.kneser import judge
    out, name = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id", "lang"])
    return out.select("doc_id", "lang", F.exp(f"{name}.log_perplexity").alias("perplexity"),
                      F.exp(f"{name}.limit").alias("max_perplexity"), F.col(f"{name}.good").alias("keep"))


@register("op8_near_duplicates")
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@register("op3_hnsw_neighbours")
def op3_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.hnsw import nearest_neighbours
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@register("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.langid import fit, identify
    docs = table(spark, sf_dir, "documents")
    out, name = identify(docs, fit(docs, ~held_out(4, 2) & F.col("doc_id").isNotNull()), ["doc_id"])
    return out.select("doc_id", held_out(4, 2).alias("held_out"), f"{name}.lang_pred", f"{name}.score")


@register("op5_licences")
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.licences import fit, scan
    docs = table(spark, sf_dir, "documents")
    out, name = scan(docs, fit(docs), ["doc_id"])
    return out.select("doc_id", f"{name}.n_paragraphs", F.size(f"{name}.notices").cast("long").alias("n_notices"),
                      F.array_join(f"{name}.families", ",").alias("families"))


def crc32_sql(value: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII text, bit by bit."""
    bit = "xor(c >> 1, 3988292384 * (c & 1))"
    codes = f"list_transform(string_split({value}, ''), lambda ch: ascii(ch)::BIGINT)"
    byte = f"list_reduce(list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {bit})"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda crc, b: {byte}), 4294967295)"


SQL_TRIE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (
  SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role,
         sha256(strlen(role) || ':' || role || text)) AS turns,
         conv_id - (conv_id % 5 + 5) % 5 AS base, {crc32_sql("conv_id::VARCHAR")} % 9 AS h
  FROM t GROUP BY conv_id),
c AS (
  SELECT l.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, l.h), list_slice(l.turns, l.h + 1, len(l.turns))) AS path
  FROM l LEFT JOIN l AS b ON l.base = b.conv_id),
m AS (SELECT conv_id, len(path) AS size, d AS depth, list_slice(path, 1, d) AS node FROM c, unnest(range(0, len(path) + 1)) AS x(d)),
n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM m GROUP BY node, depth),
k AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.node[-1].t) END AS own
  FROM n LEFT JOIN n AS p ON p.depth = n.depth - 1 AND p.node = list_slice(n.node, 1, n.depth - 1)),
f AS (SELECT k.*, EXISTS (FROM n AS q WHERE q.depth = k.depth + 1 AND list_slice(q.node, 1, k.depth) = k.node) AS inner_ FROM k)
SELECT a.conv_id, a.depth::BIGINT AS depth, a.parent_conv_id, a.n_convs,
       count(*) FILTER (WHERE s.depth = a.depth + 1) AS n_children,
       count(*) FILTER (WHERE NOT s.inner_) AS n_leaves,
       sum(s.own)::BIGINT AS saved_tokens, a.ends_sha256
FROM f AS a JOIN f AS s ON s.depth >= a.depth AND list_slice(s.node, 1, a.depth) = a.node
GROUP BY a.node, a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.ends_sha256"""


def crc32_of(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary"))


@register("op11_prefix_trie", SQL_TRIE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.prefix_trie import build_trie
    conv = F.col("conv_id")
    return build_trie(table(spark, sf_dir, "conversations"), conv - F.pmod(conv, F.lit(5)), crc32_of("conv_id") % 9, 8)


def merkle_sql(levels: int) -> str:
    """DuckDB SQL for manifests of at most ``8 ** levels`` rows a language."""
    def field(c):
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(name, rows):
        """Levels ``name0`` up (key, r, total, h), with the hashes beside each node."""
        out = [f"{name}0 AS ({rows})"]
        for k in range(levels):
            out.append(f"""{name}{k}b AS (SELECT *, coalesce(string_agg(h, '') OVER (PARTITION BY key, r // 8 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
  coalesce(string_agg(h, '') OVER (PARTITION BY key, r // 8 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS z FROM {name}{k})""")
            out.append(f"""{name}{k + 1} AS (SELECT key, r // 8 AS r, (any_value(total) + 7) // 8 AS total,
  CASE WHEN any_value(total) > 1 THEN sha256(string_agg(h, '' ORDER BY r)) ELSE any_value(h) END AS h FROM {name}{k} GROUP BY key, r // 8)""")
        return ",\n".join(out)

    def walk(name, of, parts, fold):
        """Joins of the rows of ``of`` to their nodes; texts beside them and the folded hash."""
        joins, beside, acc = [], [], fold
        for k in range(levels):
            t = f"{name}{k}b"
            joins.append(f"JOIN {t} ON {t}.key IS NOT DISTINCT FROM {of}.key AND {t}.r = {of}.r // {8 ** k}")
            beside.append(f"{t}.a || {t}.z")
            acc = f"CASE WHEN {t}.total > 1 THEN sha256({t}.a || ({acc}) || {t}.z) ELSE ({acc}) END"
        return " ".join(joins), " || ".join(beside), acc

    leaf_joins, leaf_beside, leaf_fold = walk("n", "d", None, "d.first_")
    top_joins, top_beside, top_fold = walk("t", "s", None, "w.folded")
    return f"""
WITH d AS (
  SELECT doc_id, lang AS key, {leaf("text")} AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS first_,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {leaf("text")}) - 1 AS r, count(*) OVER (PARTITION BY lang) AS total
  FROM documents),
{tree("n", "SELECT key, r, total, leaf AS h FROM d")},
s AS (
  SELECT key AS part, 0 AS key, h AS subroot, row_number() OVER (ORDER BY key IS NOT NULL, encode(key)) - 1 AS r, count(*) OVER () AS total
  FROM n{levels}),
{tree("t", "SELECT key, r, total, subroot AS h FROM s")},
w AS (SELECT d.doc_id, d.leaf, d.key AS part, {leaf_beside} AS beside, {leaf_fold} AS folded FROM d {leaf_joins}),
v AS (
  SELECT w.doc_id, w.leaf, s.subroot, t{levels}.h AS root, sha256(w.beside || {top_beside}) AS proof_sha256, {top_fold} AS folded_root
  FROM w JOIN s ON s.part IS NOT DISTINCT FROM w.part {top_joins} JOIN t{levels} ON t{levels}.key = s.key)
SELECT *, folded_root = root AS verified FROM v"""


@register("op12_merkle_manifest", merkle_sql(5))
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.manifest import build_manifest, proof_digest
    out = build_manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
                         tampered=crc32_of("doc_id") % 3 == 0)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                      "folded_root", "verified")


@register("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdscope.llm.bytebpe import decode, encode
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids, name = encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ["doc_id"])
    out, text = decode(ids, path, f"{name}.ids")
    return out.select("doc_id", f"{name}.n_tokens", F.sha2(f"{name}.ids", 256).alias("ids_sha256"), F.sha2(text, 256).alias("decoded_sha256"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
