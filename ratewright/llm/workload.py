"""The operators as queries over whole test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.llm import (
    collocations,
    fingerprints,
    jaccard,
    licenses,
    mixing,
    packing,
    pieces,
    pii,
    quality,
    secrets,
    suffix_tree,
    topk,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pii(spark, sf_dir):
    return pii.scan(read(spark, sf_dir, "documents"))


@query
def op2_imatch(spark, sf_dir):
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


@query
def op3_pieces(spark, sf_dir):
    return pieces.digest(read(spark, sf_dir, "documents"))


@query
def op4_suffix_tree(spark, sf_dir):
    return suffix_tree.scores(read(spark, sf_dir, "documents"))


@query
def op5_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


@query
def op6_top_products(spark, sf_dir):
    found = topk.top_k(read(spark, sf_dir, "embeddings"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query
def op7_secrets(spark, sf_dir):
    return secrets.scan(read(spark, sf_dir, "documents"))


@query
def op8_jaccard(spark, sf_dir):
    return jaccard.join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op9_fair_mix(spark, sf_dir):
    found = mixing.mix(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op10_licenses(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents"))


@query
def op11_best_fit(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"))


@query
def op12_setm_phrases(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query
def op13_whitening(spark, sf_dir):
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


ORACLE = {
    "op6_top_products": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings),
        scored AS (
          SELECT q.vec_id AS query_id, c.vec_id,
            CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
          FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op9_fair_mix": f"""
        WITH docs AS (
          SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
            md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
          FROM documents),
        sizes AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
            CAST([5.0, 2.0, 1.0][1 + CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INT)] AS DOUBLE)
              AS weight
          FROM docs GROUP BY source),
        held AS (SELECT *, 3 * CAST(source_size AS DOUBLE) AS ceiling FROM sizes),
        leveled AS (
          SELECT *,
            (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(ceiling) OVER (
               ORDER BY ceiling / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (
               ORDER BY ceiling / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM held),
        opened AS (SELECT *, max(CASE WHEN level * weight < ceiling THEN level END) OVER () AS common FROM leveled),
        plan AS (
          SELECT source, source_size, weight,
            CASE WHEN coalesce(common * weight < ceiling, false) THEN common * weight ELSE ceiling END AS target
          FROM opened),
        timed AS (
          SELECT d.*, p.source_size, p.target,
            sum(size) OVER (PARTITION BY d.source ORDER BY place, size ROWS UNBOUNDED PRECEDING) AS upto
          FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
        line AS (
          SELECT *, CAST(turn * source_size + upto AS DOUBLE) / target AS finish
          FROM timed, (SELECT unnest([0, 1, 2]) AS turn) WHERE source_size > 0 AND target > 0),
        queued AS (
          SELECT *, sum(size) OVER (ORDER BY finish, place, turn, size ROWS UNBOUNDED PRECEDING) AS so_far FROM line),
        chosen AS (
          SELECT doc_id, count(*) AS copies FROM queued
          WHERE so_far <= (SELECT floor(sum(target) + 1e-6) FROM plan) GROUP BY doc_id)
        SELECT t.doc_id, t.size, t.source_size, t.target, CAST(coalesce(c.copies, 0) * t.size AS BIGINT) AS taken
        FROM timed t LEFT JOIN chosen c ON c.doc_id IS NOT DISTINCT FROM t.doc_id""",
    "op12_setm_phrases": """
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, p
          FROM (SELECT lang, unnest(regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^.,;:!?\\x0A-\\x0D]+')) AS p FROM documents)),
        split AS (SELECT lang, piece, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM split GROUP BY lang),
        spans AS (
          SELECT lang, unnest(flatten(list_transform(range(1, 6), lambda k:
            list_transform(range(1, greatest(len(w) - k, -1) + 2), lambda i: w[i : i + k - 1])))) AS words
          FROM split WHERE len(w) > 0),
        f AS (SELECT lang, words, count(*) AS n FROM spans GROUP BY lang, words HAVING count(*) >= 100),
        cut AS (
          SELECT c.lang, c.words, CAST(c.n AS HUGEINT) AS a, k, CAST(h.n AS HUGEINT) AS l, CAST(t.n AS HUGEINT) AS r, totals.n AS n,
            (1000::HUGEINT * c.n * totals.n) // (CAST(h.n AS HUGEINT) * t.n) AS score
          FROM (SELECT *, unnest(range(1, len(words))) AS k FROM f WHERE len(words) > 1) c
          JOIN f h ON h.lang = c.lang AND h.words = c.words[1 : k]
          JOIN f t ON t.lang = c.lang AND t.words = c.words[k + 1 : len(c.words)]
          JOIN totals ON totals.lang = c.lang),
        best AS (
          SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
        inside AS (
          SELECT lang, words, max(n) AS most FROM (
            SELECT lang, n, unnest(flatten(list_transform(range(2, len(words)), lambda k:
              list_transform(range(1, len(words) - k + 2), lambda i: words[i : i + k - 1])))) AS words
            FROM f WHERE len(words) > 2)
          GROUP BY lang, words),
        kept AS (
          SELECT b.*, array_to_string(b.words, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.words = b.words
          WHERE i.most IS NULL OR 100 * i.most < 100 * b.a),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
          CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked WHERE rank <= 2000""",
}
