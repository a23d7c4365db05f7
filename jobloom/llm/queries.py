"""The registered queries of these operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.llm import (
    bitslice, interleave, langid, leaks, maintext, mixing, negatives, ngramjoin, quality, substrings,
    tokencount, vectorcodes, warc,
)
from jobloom.llm.ship import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.token_counts(_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("h")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP3 = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k
        FROM item WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
gram AS (
  SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM doc),
       (SELECT DISTINCT n FROM win)
  WHERE k + n - 1 <= len(w)),
hit AS (SELECT r, k, gram.n, item_id FROM gram JOIN win ON win.g = gram.g AND win.n = gram.n),
word AS (SELECT r, count(DISTINCT p) AS n_hit
         FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN items USING (r)
"""


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP4 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
    AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(_table(spark, sf_dir, "pages"))
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", "refers_to")


OP5 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d
  FROM pages),
g AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN g USING (d)
"""

def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngramjoin.similar_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


OP7 = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + least(len(w), 4) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS k
            FROM doc WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
         FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
         WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT x AS a, x AS b FROM both_ways
          UNION SELECT reach.a, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.b)
SELECT doc.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
  coalesce(r.c, doc.doc_id) AS component_id
FROM doc LEFT JOIN n ON n.doc_id = doc.doc_id
LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = doc.doc_id
"""

def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_words(_table(spark, sf_dir, "documents")).drop("kept")


OP9 = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
win AS (SELECT r, k, array_to_string(w[k:k + 34], ' ') AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS k FROM doc WHERE len(w) >= 35)),
again AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(k, k + 35)) AS p FROM win SEMI JOIN again USING (g)),
word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM doc),
kept AS (SELECT word.r, count(*) FILTER (gone.p IS NOT NULL) AS n_removed,
           coalesce(string_agg(x, ' ' ORDER BY word.p) FILTER (gone.p IS NULL), '') AS t
         FROM word LEFT JOIN gone ON gone.r = word.r AND gone.p = word.p GROUP BY word.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract(_table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave.interleave(_table(spark, sf_dir, "documents"))


# The checksum is worked out bit by bit: 3988292384 is the polynomial of CRC-32, low bit first.
OP11 = """
WITH r AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size,
    4294967295 - list_reduce(list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z:
        CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS text_crc32
  FROM documents),
told AS (SELECT *, coalesce('=' || source, '-') AS name,
  row_number() OVER (PARTITION BY doc_id, source, size, text_crc32) - 1 AS copy FROM r),
shuffled AS (SELECT *, CAST('0x' || substr(md5('=0|' || coalesce('=' || doc_id, '-') || '|=' || size
  || '|=' || text_crc32 || '|=' || copy), 1, 15) AS BIGINT) AS o FROM told),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY name ORDER BY o, doc_id, size, text_crc32, copy)
    - 1 + CAST(CAST('0x' || substr(md5('=0|=' || name), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0)
  / CAST(count(*) OVER (PARTITION BY name) AS DOUBLE) AS f FROM shuffled),
placed AS (SELECT *, row_number() OVER (ORDER BY f, name) - 1 AS place, count(*) OVER () AS n FROM ranked)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
  CAST(place * 40 // n AS INTEGER) AS shard,
  CAST(place - ((place * 40 // n) * n + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(
        F.col("label"))
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP12 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r AS anchor, q.vec_id AS anchor_id, c.r, c.vec_id, c.label = q.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r),
p AS (
  SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (
    PARTITION BY anchor, positive ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id NULLS LAST) <= 10
"""


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.coded(_table(spark, sf_dir, "embeddings"))


def _nearest(i: int) -> str:
    """Assignment a{i} to the codebook c{i}."""
    return f"""
a{i} AS (SELECT r, k, min(d) AS d, arg_min(e, d * 256 + e) AS e FROM (
    SELECT p.r, p.k, c.e, CAST(coalesce(list_sum(list_transform(list_zip(p.x, c.x),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0) AS BIGINT) AS d
    FROM p JOIN c{i} c ON c.k = p.k) GROUP BY r, k)"""


def _means(i: int) -> str:
    """The codebook c{i} from the one before and its assignment."""
    return f"""
c{i} AS (SELECT c.k, c.e, coalesce(m.x, c.x) AS x FROM c{i - 1} c LEFT JOIN (
    SELECT k, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS x FROM (
      SELECT k, e, j, sum(y) AS s, count(*) AS n FROM (
        SELECT p.k, a.e, unnest(p.x) AS y, unnest(range(len(p.x))) AS j
        FROM p JOIN a{i - 1} a ON a.r = p.r AND a.k = p.k) GROUP BY k, e, j) GROUP BY k, e) m
  ON m.k = c.k AND m.e = c.e)"""


OP13 = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, k, v[k * len(v) // 4 + 1:(k + 1) * len(v) // 4] AS x
      FROM (SELECT r, v, unnest(range(4)) AS k FROM v)),
c0 AS (SELECT k, r AS e, x FROM p WHERE r < 256),
{",".join(_nearest(i) + "," + _means(i + 1) for i in range(4))},
{_nearest(4)},
book AS (SELECT sha256(string_agg(y, ',' ORDER BY k, e, j)) AS h FROM (
  SELECT k, e, unnest(x) AS y, unnest(range(len(x))) AS j FROM c4)),
code AS (SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY k) AS code,
           CAST(sum(d) AS BIGINT) AS error FROM a4 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT h FROM book) AS codebooks_sha256
FROM v JOIN code USING (r)
"""

QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_mix_sources, op3_decontaminate, op4_top_k, op5_warc, op6_language,
    op7_ngram_join, op8_main_text, op9_substring_dedup, op10_quality, op11_interleave,
    op12_hard_negatives, op13_vector_codes)}
ORACLE = {"op3_decontaminate": OP3, "op4_top_k": OP4, "op5_warc": OP5, "op7_ngram_join": OP7,
          "op9_substring_dedup": OP9, "op11_interleave": OP11, "op12_hard_negatives": OP12,
          "op13_vector_codes": OP13}
