"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm import bpe as BP
from riskline.llm import centroids as CE
from riskline.llm import exact_dedup as ED
from riskline.llm import filter_audit as FA
from riskline.llm import language as LA
from riskline.llm import near_dedup as ND
from riskline.llm import ngram_lm as LM
from riskline.llm import packing as PK
from riskline.llm import passage_dedup as PD
from riskline.llm import quality as QU
from riskline.llm import suffix_dedup as SD
from riskline.llm import topk as TK
from riskline.llm import url_filter as UF
from riskline.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            TWINS[name] = sql
        return f

    return add


@register("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UF.url_filter(read_table(spark, sf_dir, "pages"), UF.labelled_urls(spark))


@register("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = BP.bpe_round_trip(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register(
    "op3_lm_score",
    r"""
WITH w AS (SELECT doc_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
             lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS w3,
             generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), 1) AS i FROM documents),
t AS (SELECT doc_id, i, w3, lag(w3, 1) OVER p AS w2, lag(w3, 2) OVER p AS w1 FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
u1 AS (SELECT *, sum(n) OVER (PARTITION BY w3) AS c FROM (SELECT doc_id, w3, count(*) AS n FROM t GROUP BY ALL)),
u2 AS (SELECT *, sum(n) OVER (PARTITION BY w2, w3) AS c FROM (SELECT doc_id, w2, w3, count(*) AS n FROM t WHERE w2 IS NOT NULL GROUP BY ALL)),
u3 AS (SELECT *, sum(n) OVER (PARTITION BY w1, w2, w3) AS c FROM (SELECT doc_id, w1, w2, w3, count(*) AS n FROM t WHERE w1 IS NOT NULL GROUP BY ALL)),
s AS (SELECT doc_id, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS rest, w1, w2,
             a.c - a.n AS c3, v.c - v.n AS c2, b.c - b.n AS c23, x.c - x.n AS c12, y.c - y.n AS c123
      FROM t LEFT JOIN u1 a USING (doc_id, w3)
      LEFT JOIN (SELECT doc_id, w3 AS w2, n, c FROM u1) v USING (doc_id, w2)
      LEFT JOIN u2 b USING (doc_id, w2, w3)
      LEFT JOIN (SELECT doc_id, w2 AS w1, w3 AS w2, n, c FROM u2) x USING (doc_id, w1, w2)
      LEFT JOIN u3 y USING (doc_id, w1, w2, w3)),
l AS (SELECT doc_id, CASE WHEN c123 > 0 THEN ln(c123) - ln(c12)
             ELSE CASE WHEN w1 IS NOT NULL THEN ln(0.4) ELSE 0 END
                  + CASE WHEN c23 > 0 THEN ln(c23) - ln(c2)
                         ELSE CASE WHEN w2 IS NOT NULL THEN ln(0.4) ELSE 0 END + ln(greatest(c3, 0.5) / greatest(rest, 1)) END END AS g FROM s)
SELECT d.doc_id, count(g) AS n_words, round(avg(g), 6) AS score FROM documents d LEFT JOIN l USING (doc_id) GROUP BY d.doc_id""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LM.lm_scores(read_table(spark, sf_dir, "documents")).withColumn("score", F.round("score", 6))


@register(
    "op4_minhash_dedup",
    r"""
WITH RECURSIVE w AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
               lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
h AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM h a JOIN h b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a),
c AS (SELECT node, min(root) AS root FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id,
       coalesce(c.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ND.near_dedup(read_table(spark, sf_dir, "documents"))


@register(
    "op5_suffix_dedup",
    """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, unnest(range(0, n - 49)) AS p, x FROM t),
v AS (SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS s FROM w),
m AS (SELECT s, min(doc_id) AS f FROM v GROUP BY s),
g AS (SELECT doc_id, p FROM v JOIN m USING (s) WHERE f < doc_id),
o AS (SELECT *, max(p + 50) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM g),
i AS (SELECT *, sum(CASE WHEN e IS NULL OR p > e THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM o),
sp AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY ALL),
q AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS lo FROM sp
      UNION ALL SELECT doc_id, n, n, coalesce((SELECT max(b) FROM sp WHERE sp.doc_id = t.doc_id), 0) FROM t),
k AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) - 1 AS n_spans,
             string_agg(substr(x, 2 * lo + 1, 2 * (a - lo)), '' ORDER BY lo, a) AS kept
      FROM q JOIN t USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM t JOIN k USING (doc_id)""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = SD.suffix_dedup(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LA.identify(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@register(
    "op7_topk",
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.e, x.e) AS BIGINT) AS score
           FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@register("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QU.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return PK.pack(PK.token_pieces(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")))


@register(
    "op10_exact_dedup",
    r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
     g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ED.exact_dedup(read_table(spark, sf_dir, "documents"))


def _cluster_rounds(rounds: int) -> str:
    """CTEs a0, c1, a1, ... of the clustering: the vectors' nearest centroids, then the moved centroids."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""a{i} AS (SELECT vec_id, e, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT vec_id, e, c, CAST(list_sum(list_transform(list_zip(e, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
  FROM v, c{i}) GROUP BY vec_id, e)""")
        if i < rounds:
            out.append(f"""c{i + 1} AS (SELECT c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (
  SELECT c, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS m FROM (
    SELECT c, i, sum(e[i]) AS s, count(*) AS n FROM a{i}, range(1, 65) g(i) GROUP BY ALL) GROUP BY c) n USING (c))""")
    return ",\n".join(out)


@register(
    "op11_centroids",
    f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, e AS m FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v ORDER BY h LIMIT 16)),
{_cluster_rounds(3)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (c)""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CE.cluster(read_table(spark, sf_dir, "embeddings")).drop("compared")


@register(
    "op12_passage_dedup",
    r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i,
             unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS s FROM t),
m AS (SELECT s, min(doc_id) AS f FROM w GROUP BY s),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM w JOIN m USING (s) WHERE f < doc_id),
a AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM t),
k AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS kept FROM a ANTI JOIN g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (doc_id)""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = PD.passage_dedup(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register(
    "op13_filter_audit",
    r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
             coalesce(least < doc_id, false) AS e,
             EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.quality = 1) AS good,
             EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.toxic = 1) AS toxic FROM w),
x AS (SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
             || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails, good, toxic FROM f),
y AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x FROM x GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS z),
o AS (SELECT p.z || q.z || r.z || s.z || u.z AS filter_order FROM l p JOIN l q ON q.z <> p.z JOIN l r ON r.z NOT IN (p.z, q.z)
      JOIN l s ON s.z NOT IN (p.z, q.z, r.z) JOIN l u ON u.z NOT IN (p.z, q.z, r.z, s.z)),
k AS (SELECT filter_order, CAST(i AS INTEGER) AS step, substr(filter_order, i, 1) AS own, substr(filter_order, 1, i - 1) AS before
      FROM o, range(1, 6) t(i)),
c AS (SELECT part, filter_order, step, own, n, g, x, fails, contains(fails, own) AS hit,
             length(translate(fails, before, '')) < length(fails) AS gone FROM y, k)
SELECT part, filter_order, step, CAST(coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (WHERE fails = own), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(g) FILTER (WHERE hit AND NOT gone), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(x) FILTER (WHERE hit AND NOT gone), 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM c GROUP BY part, filter_order, step, own""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FA.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
