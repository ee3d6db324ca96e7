"""The operators over the test tables, with production parameters and whole inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evolve.llm import bpe, embedding_dedup, hard_negatives, licenses, line_dedup, near_duplicates, neighbours, packing, phrases, pii, quality, token_counts, toxicity
from evolve.llm.common import table


def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op2_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), with_ids=False)


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.decode(bpe.encode(table(spark, folder, "documents"))))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit_on(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.over_limit(token_counts.token_counts(table(spark, folder, "documents")))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, folder, "documents")))


def op7_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.summary(pii.detect(table(spark, folder, "documents")))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.report(docs, line_dedup.decisions(docs, exact=line_dedup.EXACT))


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality.score(docs, quality.fit_on(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "n_bytes", "bad_bytes", "good_bytes",
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_embedding_dedup, op2_pack_sequences, op3_bpe_round_trip, op4_toxicity, op5_token_counts, op6_license_scan,
        op7_nearest_neighbours, op8_personal_data, op9_near_duplicates, op10_line_dedup, op11_quality,
        op12_hard_negatives, op13_collocations,
    )
}
# The other operators' results hang on tokenizers, learned models or hashes, which SQL does not have.
SQL: dict[str, str] = {
    "op1_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
r AS (SELECT vec_id AS id, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links,
  coalesce((SELECT min(root) FROM r WHERE r.id = e.vec_id), e.vec_id) AS component_id,
  e.vec_id = coalesce((SELECT min(root) FROM r WHERE r.id = e.vec_id), e.vec_id) AS kept
FROM embeddings e
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor, p.id AS positive, s.id, p.score AS ps, s.score AS ns, row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank, id AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE rank <= 5
""",
    "op13_collocations": r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) AS t(k)),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, h.f AS l, t.f AS r, n.n, h.k AS head,
    (1000::HUGEINT * c.f * n.n) // (h.f::HUGEINT * t.f) AS score
  FROM f c JOIN f h ON c.lang = h.lang AND h.k < c.k AND h.phrase = array_to_string(c.ws[1:h.k], ' ')
  JOIN f t ON c.lang = t.lang AND t.k = c.k - h.k AND t.phrase = array_to_string(c.ws[h.k + 1:c.k], ' ')
  JOIN n ON c.lang = n.lang
),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, head) = 1),
part AS (
  SELECT c.lang, array_to_string(c.ws[s.i:s.i + m.m - 1], ' ') AS phrase, max(c.f) AS longer
  FROM f c, range(2, 5) AS m(m), range(1, 5) AS s(i) WHERE m.m < c.k AND s.i + m.m - 1 <= c.k GROUP BY 1, 2
),
kept AS (SELECT b.* FROM best b LEFT JOIN part q ON b.lang = q.lang AND b.phrase = q.phrase WHERE q.longer IS NULL OR 100 * q.longer < 100 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
""",
}
