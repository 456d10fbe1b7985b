"""Registered queries of the pipeline operators and their DuckDB twins.

Each builder is ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` holds the SQL of
those that SQL can express. The others are tested in ``tests/llm``.
"""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from riskflow.llm import (
    bucket_digest,
    byte_bpe,
    centroids,
    decontamination,
    edit_counts,
    language_id,
    license_scan,
    near_dedup,
    quality_ranking,
    secret_scan,
    sharding,
    spelling,
    warc_zip,
)
from riskflow.llm.common import id_remainder, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_warc_zip(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc_zip.archive_round_trip(pages).drop("url")


ORACLES["op1_warc_zip"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_page FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM f"""


@query
def op2_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, words=4, percent=80)


# Exact: every pair that shares a shingle, then the smallest id reachable over the links.
ORACLES["op2_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM e a JOIN e b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 80 * (a.n + b.n - common)),
reach AS (SELECT doc_id, doc_id AS other FROM n UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON link.x = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN least USING (doc_id)"""


@query
def op3_quality_ranking(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    model = quality_ranking.train(docs, labels.where(~held_out))
    return quality_ranking.scored(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op4_license_scan"] = license_scan.oracle()


@query
def op5_bucket_digest(spark, sf_dir):
    return bucket_digest.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_secret_scan(spark, sf_dir):
    found = secret_scan.findings(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", F.col("start").cast("long").alias("start"), F.length("cand").cast("long").alias("n_chars"),
                        F.sha2("cand", 256).alias("candidate_sha256"), "score", "is_secret")


@query
def op7_edit_counts(spark, sf_dir):
    """Counts before and after three edits a document: a replacement, a deletion and an appended word."""
    n = "cast(coalesce(length(text), 0) as int)"
    docs = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text",
        f"array(named_struct('start', {n} div 3, 'length', 12L, 'replacement', coalesce(source, '')),"
        f" named_struct('start', {n} * 2 div 3, 'length', 20L, 'replacement', ''),"
        f" named_struct('start', cast({n} as long), 'length', 0L, 'replacement', concat(' ', coalesce(lang, '')))) edits")
    rank_file, pattern = byte_bpe.default_tokenizer()
    return edit_counts.count_edited(docs, rank_file, pattern)


def held_out_language():
    return F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))


@query
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs, ~held_out_language())
    return language_id.identify(docs, model).select(
        "doc_id", held_out_language().alias("held_out"), "lang_pred", "score")


@query
def op9_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.summarize(decontamination.leaks(docs, table(spark, sf_dir, "benchmark")))


@query
def op10_byte_bpe(spark, sf_dir):
    rank_file, pattern = byte_bpe.default_tokenizer()
    rows = byte_bpe.tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), rank_file, pattern)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")


@query
def op11_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op12_centroids(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return centroids.report(*centroids.cluster(vectors, clusters=16, rounds=3, dimensions=64, scale=64, seed="1"))


def _lloyd_sql(rounds: int = 3) -> str:
    """The rounds written out: assignments a0, a1, ... and centroids c0, c1, ..."""
    bound = float(centroids.COMPONENT_BOUND)
    distance = "list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, min(d) AS d, arg_min(k, (d, k)) AS k
  FROM (SELECT r, k, {distance} AS d FROM v, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT a.k, j, sum(q[j])::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i} a JOIN v USING (r), range(1, 65) t(j) GROUP BY a.k, j),
m{i} AS (SELECT k, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY j) AS c FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT o.k, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN m{i} m USING (k))""")
    body = ",\n".join(steps)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(greatest(least(64 * x::DOUBLE, {bound}), -{bound}))::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS k, q AS c
  FROM (SELECT q, sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v) ORDER BY h, q LIMIT 16),
{body}
SELECT vec_id, a.k::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c USING (k)"""


ORACLES["op12_centroids"] = _lloyd_sql()


@query
def op13_spelling(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


# The checksum is spelled out: its table of 256 entries follows from the one-byte checksums.
_CRC_TABLE = [zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)]
ORACLES["op13_spelling"] = f"""
WITH RECURSIVE t AS (SELECT {_CRC_TABLE}::BIGINT[] AS crc),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
u AS (SELECT doc_id, run, count(*) AS n FROM d GROUP BY ALL),
b AS (SELECT doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
        lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + ord(c) // 64, 128 + ord(c) % 64]::BIGINT[] END)) AS bytes FROM u),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
        lambda a, x: xor(a >> 8, t.crc[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM v, range(1, length(word) + 1) r(i)),
p AS (SELECT a.word, b.word AS near FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.rest
      UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.rest),
g AS (SELECT p.word, count(*) AS n_near, arg_min(near, (-o.n, near)) AS best, max(o.n) AS best_n FROM p JOIN v o ON o.word = p.near GROUP BY p.word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form,
        CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n FROM v LEFT JOIN g USING (word)),
walk AS (SELECT word, word AS at FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN walk USING (word) JOIN f l ON l.word = walk.at WHERE l.form IS NULL"""
