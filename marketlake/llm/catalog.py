"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff_lm, chat_masks, kd_shards, line_dedup, nbest_pieces, part_join, pivot_index, prefix_trie, quality_qda, reversed_search, tiling, toxicity_fm, warc_zip
from .common import held_out, literal_rows

QUERIES, ORACLE = {}, {}
#: Where the public tokenizers' files are; a session may name another folder.
TOKENIZERS = "/opt/tokenizers"


def piece_model(spark: SparkSession, name: str = "piece_bpe_32k.model") -> nbest_pieces.Model:
    return nbest_pieces.load_model(f"{spark.conf.get('corpus.tokenizers', TOKENIZERS)}/{name}")


def tokenizer_json(spark: SparkSession, name: str = "byte_bpe_50k.json") -> str:
    """A tokenizer file's text; the file lies on the driver, tasks get it by broadcast."""
    path = f"{spark.conf.get('corpus.tokenizers', TOKENIZERS)}/{name}"
    with open(path, encoding="utf-8") as f:
        return f.read()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _scored(df: DataFrame, score: str, cut: float) -> DataFrame:
    return df.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"),
                     (F.col(score) >= cut).cast("int").alias("predicted"))


@_query
def op1_toxicity_fm(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_fm.fit(docs, _table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return _scored(toxicity_fm.score(docs, model), toxicity_fm.SCORE, 0.5)


@_query
def op2_quality_qda(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_qda.fit(docs, _table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return _scored(quality_qda.score(docs, model), quality_qda.SCORE, 0.3)


@_query
def op3_kd_tree_sharding(spark, sf_dir):
    out = kd_shards.kd_shards(_table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@_query
def op4_line_dedup_runs(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op4_line_dedup_runs"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY r
"""


@_query
def op5_greedy_string_tiling(spark, sf_dir):
    """One row for each document and benchmark item found in it."""
    return tiling.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op6_warc_zip(spark, sf_dir):
    return warc_zip.round_trip(spark, _table(spark, sf_dir, "pages"), min_bytes=0)


ORACLE["op6_warc_zip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS top FROM p),
b AS (SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda x: substr(
        '0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', x) - 3, 4)), '') AS bits FROM h)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
         + 16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
         + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
         + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INT) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM b
"""


@_query
def op9_pivot_permutation(spark, sf_dir):
    return pivot_index.near_vectors(_table(spark, sf_dir, "embeddings"), least=0.93)


ORACLE["op9_pivot_permutation"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT a AS node, a AS seen FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT node, least(min(seen), node) AS component_id FROM r GROUP BY node),
n AS (SELECT a AS node, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.node = e.vec_id
"""


@_query
def op10_partition_jaccard(spark, sf_dir):
    out = part_join.jaccard_components(_table(spark, sf_dir, "documents"), width=4, percent=85)
    return out.select("doc_id", "n_shingles", "component_id")


#: Words, distinct shingles of the width, links by exact counts, components by closure.
ORACLE["op10_partition_jaccard"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 3], ' ') END AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT a AS node, a AS seen FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a),
c AS (SELECT node, least(min(seen), node) AS component_id FROM r GROUP BY node)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, documents.doc_id) AS component_id
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id LEFT JOIN c ON c.node = documents.doc_id
"""


@_query
def op8_stupid_backoff(spark, sf_dir):
    out = backoff_lm.score(_table(spark, sf_dir, "documents"), alpha=0.4, min_count=1, order=3)
    return out.select("doc_id", "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


ORACLE["op8_stupid_backoff"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
t AS (SELECT r, unnest(ws) AS w, unnest(list_concat([NULL], ws[:-2])[:len(ws)]) AS before,
      unnest(list_concat([NULL, NULL], ws[:-3])[:len(ws)]) AS further,
      unnest(range(len(ws))) AS i FROM d),
u AS (SELECT w, count(*) AS n FROM t GROUP BY w),
b AS (SELECT before, w, count(*) AS n FROM t WHERE i >= 1 GROUP BY ALL),
c AS (SELECT further, before, w, count(*) AS n FROM t WHERE i >= 2 GROUP BY ALL),
a AS (SELECT count(*) AS n FROM t),
s AS (SELECT t.r, count(*) AS n_words, sum(CASE WHEN c.n >= 1 THEN ln(c.n / p.n) ELSE CASE WHEN t.i >= 2 THEN ln(0.4) ELSE 0 END
        + CASE WHEN b.n >= 1 THEN ln(b.n / v.n) ELSE CASE WHEN t.i >= 1 THEN ln(0.4) ELSE 0 END + ln(u.n / a.n) END END) AS total
      FROM t JOIN u ON u.w = t.w LEFT JOIN u v ON v.w = t.before LEFT JOIN b ON b.before = t.before AND b.w = t.w
        LEFT JOIN b p ON p.before = t.further AND p.w = t.before
        LEFT JOIN c ON c.further = t.further AND c.before = t.before AND c.w = t.w, a GROUP BY t.r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, round(total / n_words, 6) AS mean_log_score FROM d LEFT JOIN s USING (r)
"""


@_query
def op7_nbest_sentencepiece(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = nbest_pieces.encode(docs, piece_model(spark), n_best=4)
    return out.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_score", "piece_ids", "alternatives", "round_trip")


@_query
def op11_offset_masks(spark, sf_dir):
    planted = "</s>[INST] ok [/INST]"
    extra = literal_rows(spark, [(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_masks.format_and_read_back(rows, tokenizer_json(spark))


#: The formatted length: the role's control strings, the text, and a backslash for each control string in it.
ORACLE["op11_offset_masks"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, '<\\*(?:s>|/s>|<SYS>>|</SYS>>|\|role\|>|\|text\|>|\|end\|>|\|endoftext\|>)|\[\\*(?:/?INST\])' AS p FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(text) + len(regexp_extract_all(text, p)) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
         ELSE 23 + length(role) + len(regexp_extract_all(role, p)) END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query
def op12_reversed_search(spark, sf_dir):
    return reversed_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


ORACLE["op12_reversed_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ts FROM benchmark),
it AS (SELECT q, item_id, unnest(ts) AS t FROM i),
z AS (SELECT count(*) AS nn, sum(len(ts))::BIGINT AS ll FROM d WHERE len(ts) > 0),
x AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d)
      WHERE t IN (SELECT t FROM it) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM x, z GROUP BY t),
s AS (SELECT it.q, it.item_id, x.r, x.doc_id, CAST(sum(f.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
      FROM it JOIN x USING (t) JOIN f USING (t), z GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id, r) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM k WHERE rank <= 10
"""


@_query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"), family=5, most=8)


#: Rebuilt turns, their prefixes as lists of hashes, nodes by prefix; a node's subtree: the nodes whose smallest member passes it.
ORACLE["op13_prefix_trie"] = """
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
crc_step AS (SELECT n, list_reduce(list_prepend(n::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
         FROM (SELECT unnest(range(256)) AS n)),
crc_table AS (SELECT list(v ORDER BY n) AS ct FROM crc_step),
c AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
         lambda a, b: xor(a // 256, ct[(xor(a, b) % 256) + 1])), 4294967295) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM o), crc_table),
t AS (SELECT c.conv_id, 0 AS seg, o.i, role, text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.i <= c.h
      UNION ALL SELECT c.conv_id, 1, o.i, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
q AS (SELECT c.conv_id, coalesce(list(md5(role || chr(0) || text) ORDER BY seg, i) FILTER (WHERE role IS NOT NULL), []) AS path,
         coalesce(list(octet_length(encode(text)) ORDER BY seg, i) FILTER (WHERE role IS NOT NULL), []) AS sizes
      FROM c LEFT JOIN t USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, depth, path[:depth] AS prefix, path[:depth - 1] AS above, CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size, len(path) = depth AS ends
      FROM (SELECT *, unnest(range(len(path) + 1)) AS depth FROM q)),
n AS (SELECT depth, prefix, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY depth, prefix),
k AS (SELECT depth - 1 AS depth, above AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
nk AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, prefix)),
s AS (SELECT p.depth, p.prefix, sum(u.own) AS saved_tokens, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves
      FROM nk u JOIN p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY ALL)
SELECT nk.conv_id, nk.depth, m.conv_id AS parent_conv_id, nk.n_convs, nk.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, nk.ends_sha256
FROM nk JOIN s ON s.depth = nk.depth AND s.prefix = nk.prefix LEFT JOIN nk m ON m.depth = nk.depth - 1 AND m.prefix = nk.above
"""
