"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (debruijn, exact_dedup, fim, mixing, ngram_join, packing, pii, quality, suffix_dedup,
                            token_store, toxicity, vector_codes, vector_dedup)
from ledgerlens.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.ledgerlens.pseudonymKey", "set-spark.ledgerlens.pseudonymKey")
    return pii.pseudonymise_documents(table(spark, sf_dir, "documents"), key.encode()[:64])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(table(spark, sf_dir, "documents"), length=35, k=16)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_digest(table(spark, sf_dir, "documents"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_digest(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_exact_dedup, op3_toxicity, op4_ngram_join, op5_suffix_dedup, op6_quality,
                            op7_mixing, op8_vector_dedup, op9_packing, op10_substring_dedup,
                            op11_fill_in_middle, op12_token_store, op13_vector_codes)}


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds of ``vector_codes`` one after the other: nearest entries, then their parts' means."""
    ctes = [f"""
        x AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding::DOUBLE[]) AS r, vec_id, label,
                   list_transform(embedding::DOUBLE[], lambda y: floor(4096 * y)::BIGINT) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
        w AS (SELECT (max(len(e)) // {parts})::BIGINT AS w FROM x),
        v AS MATERIALIZED (
            SELECT r, p.p, e[p.p * w + 1:(p.p + 1) * w] AS e FROM x, w, range({parts}) AS p(p)),
        b0 AS MATERIALIZED (SELECT p, r - 1 AS k, e FROM v WHERE r <= {entries})"""]
    distance = "list_sum(list_transform(range(1, len(v.e) + 1), lambda i: (v.e[i] - b.e[i]) * (v.e[i] - b.e[i])))"
    for i in range(rounds + 1):
        ctes.append(f"""
        a{i} AS MATERIALIZED (
            SELECT v.r, v.p, min((d.d, d.k)) AS m FROM v, LATERAL (
                SELECT {distance}::BIGINT AS d, b.k FROM b{i} b WHERE b.p = v.p) d GROUP BY v.r, v.p)""")
        if i < rounds:
            ctes.append(f"""
        s{i} AS MATERIALIZED (
            SELECT p, k, list(q ORDER BY i) AS e FROM (
                SELECT v.p, a.m[2] AS k, j.i, (sum(v.e[j.i]) // count(*)
                       - CASE WHEN sum(v.e[j.i]) % count(*) < 0 THEN 1 ELSE 0 END)::BIGINT AS q
                FROM v JOIN a{i} a ON a.r = v.r AND a.p = v.p, LATERAL (SELECT unnest(range(1, len(v.e) + 1)) AS i) j
                GROUP BY v.p, a.m[2], j.i) GROUP BY p, k),
        b{i + 1} AS MATERIALIZED (
            SELECT b.p, b.k, coalesce(s.e, b.e) AS e FROM b{i} b LEFT JOIN s{i} s ON s.p = b.p AND s.k = b.k)""")
    return f"""
        WITH {','.join(ctes)},
        c AS (SELECT r, string_agg(printf('%02x', m[2]), '' ORDER BY p) AS code, sum(m[1])::BIGINT AS error
              FROM a{rounds} GROUP BY r),
        h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds})
        SELECT x.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY x.label))::BIGINT AS label_error,
               h.codebooks_sha256
        FROM x JOIN c ON c.r = x.r, h"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op4_ngram_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE
                  WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
              FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
        l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
              WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents
              UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
        JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id""",
    "op8_vector_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
        FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op11_fill_in_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
                   regexp_extract_all(coalesce(text, ''),
                                      '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
            FROM documents),
        i AS (SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
                     ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
        f AS (SELECT doc_id, text, u, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                               OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM i),
        p AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS prefix,
                     array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM f)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                      ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p""",
    "op13_vector_codes": _codes_sql(),
    "op10_substring_dedup": f"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
        p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w),
        s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM p),
        m AS (SELECT s FROM s GROUP BY s HAVING count(*) > 1),
        g AS (SELECT s.doc_id, s.i FROM s JOIN m ON s.s = m.s),
        y AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
        c AS (SELECT y.doc_id, y.i, y.word,
                     max(g.i) OVER (PARTITION BY y.doc_id ORDER BY y.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW)
                       IS NOT NULL AS gone
              FROM y LEFT JOIN g ON g.doc_id = y.doc_id AND g.i = y.i),
        t AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
                     string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY doc_id)
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(t.n_removed, 0) AS n_removed,
               sha256(coalesce(t.kept, '')) AS kept_sha256
        FROM w LEFT JOIN t ON t.doc_id = w.doc_id""",
}
