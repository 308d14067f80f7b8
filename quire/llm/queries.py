"""The ten registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fingerprint, lm_score, ngram_join, packing, phrases, pii, quality, sharding, toxicity
from ._store import dealt, small_batches


#: A table of so many rows in fewer files than cores is dealt out to all of them.
SMALL = 100_000


def native_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores and df.count() <= SMALL else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id", "class_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(native_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(native_table(spark, sf_dir, "documents"))


def op10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.drop_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_ngram_join, op3_packing, op4_decontaminate, op5_lm_score, op6_sharding, op7_toxicity, op8_quality, op9_fingerprint, op10_phrases)
}

#: Windows of 13 words, met by equality; words as in the operator.
_OP4 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), i AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM b WHERE len(w) > 0)
), x AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n
), h AS (
    SELECT x.r, x.p, i.n, i.item_id FROM x JOIN i ON i.n = x.n AND i.s = array_to_string(x.w[x.p : x.p + x.n - 1], ' ')
), k AS (
    SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r
), m AS (
    SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(k.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(k.n_hit, 0) > 0 AND 20 * coalesce(k.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN k USING (r) LEFT JOIN m USING (r)
"""

#: Spans from the lengths of matches and of what lies between them; terms by their counts.
_AT = "list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
_OP1 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), k AS (
    SELECT * FROM (VALUES (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'), (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
        (3, 'card', '[0-9]([\x20-]?[0-9])+'), (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')) AS k(o, kind, p)
), f AS (
    SELECT r, o, kind, v, a, a + length(v) AS b, regexp_replace(v, '[^0-9]', '', 'g') AS x FROM (
        SELECT r, o, kind, m[i] AS v, CAST({at} AS BIGINT) AS a FROM (
            SELECT r, o, kind, m, string_split_regex(t, p) AS g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT *, regexp_extract_all(t, p) AS m FROM d, k)))
), s AS (
    SELECT r, o, kind, a, b, kind || ':' || CASE WHEN o < 3 THEN lower(v) ELSE x END AS e FROM f
    WHERE CASE o WHEN 1 THEN true WHEN 2 THEN list_bool_and(list_transform(string_split(v, '.'), lambda q: coalesce(TRY_CAST(q AS HUGEINT) <= 255, false)))
        WHEN 3 THEN length(x) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(x) + 1), lambda j: CASE WHEN (length(x) - j) % 2 = 0 THEN CAST(x[j] AS BIGINT)
            ELSE 2 * CAST(x[j] AS BIGINT) - CASE WHEN x[j] > '4' THEN 9 ELSE 0 END END)) % 10 = 0
        ELSE length(x) BETWEEN 9 AND 15 END
), w AS (
    SELECT r, lower(m[i]) AS term, CAST({at} AS BIGINT) AS a, length(m[i]) AS n FROM (
        SELECT r, m, g, unnest(range(1, len(m) + 1)) AS i FROM (SELECT r, regexp_extract_all(t, '[\p{L}\p{N}_]+') AS m, string_split_regex(t, '[\p{L}\p{N}_]+') AS g FROM d SEMI JOIN s USING (r)))
), o AS (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY a) AS z FROM w
    WHERE n > 2 AND NOT EXISTS (SELECT 1 FROM s WHERE s.r = w.r AND w.a < s.b AND s.a < w.a + w.n)
), c AS (
    SELECT s.r, s.a, s.e, count(o.z) FILTER (WHERE o.a < s.a) AS i, count(o.z) FILTER (WHERE o.a < s.b) AS j FROM s LEFT JOIN o USING (r) GROUP BY s.r, s.a, s.e, s.o
), y AS (
    SELECT DISTINCT c.r, c.e, o.term FROM c JOIN o ON o.r = c.r AND (o.z > c.i - 8 AND o.z <= c.i OR o.z > c.j AND o.z <= c.j + 8)
), l AS (
    SELECT e, term, n_et FROM (SELECT e, term, count(*) AS n_et, count(DISTINCT t) AS texts FROM y JOIN d USING (r) GROUP BY e, term) WHERE texts > 1
), ne AS (
    SELECT e, count(DISTINCT r) AS n_e FROM s GROUP BY e
), nt AS (
    SELECT term, count(*) AS n_t FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(t), '[\p{L}\p{N}_]+'))) AS term FROM d) GROUP BY term
), h AS (
    SELECT DISTINCT s.r, l.term FROM l JOIN ne USING (e) JOIN nt USING (term) JOIN s USING (e), (SELECT count(*) AS n FROM d)
    WHERE n > n_e AND log2(n * n_et / (n_e * n_t)) >= log2(n / n_e) / 1.25
), q AS (
    SELECT r, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY s.o, a) AS base, count(*) FILTER (WHERE s.o = 1) AS n1, count(*) FILTER (WHERE s.o = 2) AS n2, count(*) FILTER (WHERE s.o = 3) AS n3, count(*) FILTER (WHERE s.o = 4) AS n4
    FROM s GROUP BY r
), u AS (
    SELECT r, string_agg('term:' || a || ':' || (a + n), ',' ORDER BY a) AS more, count(*) AS nm FROM o JOIN h USING (r, term) GROUP BY r
)
SELECT doc_id, coalesce(n1, 0) AS n_email, coalesce(n2, 0) AS n_ip, coalesce(n3, 0) AS n_card, coalesce(n4, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, concat_ws(',', base, more) AS spans, coalesce(nm, 0) AS n_term
FROM d LEFT JOIN q USING (r) LEFT JOIN u USING (r)
""".replace("{at}", _AT)

#: Classes of equal sets, all pairs of classes with a common shingle, and what links reach.
_OP2 = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT DISTINCT r, md5(array_to_string(w[p : p + least(len(w), 4) - 1], ' ')) AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)
), e AS (
    SELECT r, count(*) AS n, md5(string_agg(g, '' ORDER BY g)) AS c FROM s GROUP BY r
), k AS MATERIALIZED (
    SELECT c, min(r) AS r, min(n) AS n, min(doc_id) AS class_id FROM e JOIN d USING (r) GROUP BY c
), t AS MATERIALIZED (
    SELECT k.c, k.n, s.g FROM k JOIN s USING (r)
), l AS MATERIALIZED (
    SELECT a.c AS a, b.c AS b FROM t a JOIN t b ON a.g = b.g AND a.c <> b.c
    GROUP BY a.c, b.c HAVING 100 * count(*) >= 85 * (min(a.n) + min(b.n) - count(*))
), x AS (
    SELECT c, class_id AS m FROM k
    UNION
    SELECT l.b, x.m FROM x JOIN l ON l.a = x.c
), m AS (
    SELECT c, min(m) AS component_id FROM x GROUP BY c
)
SELECT d.doc_id, coalesce(e.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(k.class_id, d.doc_id) AS class_id
FROM d LEFT JOIN e USING (r) LEFT JOIN k USING (c) LEFT JOIN m USING (c)
"""

#: Windows of 50 words and the least id that holds each.
_OP10 = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
    SELECT r, doc_id, p, sha256(array_to_string(w[p : p + 49], ' ')) AS s FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE doc_id IS NOT NULL AND len(w) >= 50)
), f AS (
    SELECT s, min(doc_id) AS first FROM p GROUP BY s HAVING min(doc_id) < max(doc_id)
), g AS (
    SELECT r, list(DISTINCT q) AS gone FROM (SELECT r, unnest(range(p, p + 50)) AS q FROM p JOIN f USING (s) WHERE first < doc_id) GROUP BY r
), k AS (
    SELECT d.doc_id, d.w, coalesce(len(gone), 0) AS n,
           CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE (SELECT coalesce(string_agg(w[i], ' ' ORDER BY i), '') FROM (SELECT unnest(range(1, len(w) + 1)) AS i) WHERE NOT list_contains(gone, i)) END AS kept
    FROM d LEFT JOIN g USING (r)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed, sha256(kept) AS kept_sha256 FROM k
"""

ORACLES: dict[str, str] = {"op1_pii": _OP1, "op2_ngram_join": _OP2, "op10_phrases": _OP10, "op4_decontaminate": _OP4, "op6_sharding": sharding.oracle()}


