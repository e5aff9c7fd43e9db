"""One query per operator over whole tables, and the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.llm.collocations import collocations
from cohort.llm.embedding_dedup import embedding_dedup
from cohort.llm.exact_dedup import exact_dedup
from cohort.llm.hard_negatives import hard_negatives
from cohort.llm.language_id import identify_language
from cohort.llm.license_scan import license_scan
from cohort.llm.line_dedup import line_dedup
from cohort.llm.mixing import mix_sources
from cohort.llm.packing import pack_documents
from cohort.llm.quality import classify_quality
from cohort.llm.repeats import remove_repeats
from cohort.llm.simhash import simhash_dedup
from cohort.llm.topk_search import top_k


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    lengths = F.transform("removed", lambda run: run["end"] - run["first"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda n, more: n + more).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"))

    def labels(matches: Column) -> Column:
        named = F.transform(matches, lambda m: m["label"])
        return F.array_join(F.array_sort(F.array_distinct(named)), ",")

    exact = F.filter("matches", lambda m: m["exact"])
    starts = F.transform(exact, lambda m: m["start"])
    best = F.array_max(F.transform("matches", lambda m: m["containment"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(exact).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_repeats", "mix_copy", "mix_key")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), "vec_id % 100 = 0")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_language_id": op4_language_id,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_topk_search": op11_topk_search,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Vectors as whole numbers (held by doubles, so that their products are exact).
_WHOLE = """
            SELECT vec_id, [floor({scale} * x::DOUBLE) FOR x IN embedding] AS x{more}
            FROM embeddings
            WHERE len(embedding) > 0
                  AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
"""
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op7_exact_dedup": f"""
        WITH d AS (
            SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256
            FROM documents
        ), g AS (
            SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
            FROM d GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               text_sha256
        FROM d JOIN g USING (text_sha256)
    """,
    "op9_line_dedup": f"""
        WITH d AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), l AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
        ), k AS (
            SELECT *, trim({_LOWER.format("line")}, {_SPACES}) AS key FROM l
        ), shared AS (
            SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), marked AS (
            SELECT k.*, holder IS NOT NULL AND doc_id <> holder AS gone
            FROM k LEFT JOIN shared USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op10_mixing": """
        WITH s AS (
            SELECT source, sum(strlen(coalesce(text, '')) + 1) AS size FROM documents
            GROUP BY source
        ), w AS (
            SELECT source, pow(size::DOUBLE, 0.5) / (SELECT sum(pow(size::DOUBLE, 0.5)) FROM s)
                   * (SELECT sum(size) FROM s)::DOUBLE / size::DOUBLE AS rate
            FROM s
        ), t AS (
            SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
            FROM (SELECT source, rate,
                         unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k
                  FROM w)
        ), c AS (
            SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM t
        ), u AS (
            SELECT doc_id, source, coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS name,
                   (CAST('0x' || substr(md5('mix-1:' || name), 1, 13) AS BIGINT) + 0.5)
                   / 4503599627370496.0::DOUBLE AS u
            FROM documents
        ), n AS (
            SELECT doc_id, name, u.source, count(*) FILTER (cdf < u) AS mix_repeats
            FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source GROUP BY doc_id, name, u.source
        ), e AS (
            SELECT doc_id, name, source, mix_repeats, unnest(range(0, mix_repeats)) AS mix_copy FROM n
        )
        SELECT doc_id, source, mix_repeats::INT AS mix_repeats, mix_copy::INT AS mix_copy,
               md5('mix-1:order:' || name || ':' || mix_copy) AS mix_key
        FROM e
    """,
    "op11_topk_search": f"""
        WITH v AS ({_WHOLE.format(scale=1024, more="")})
        SELECT q.vec_id AS query_id,
               row_number() OVER (
                   PARTITION BY q.vec_id ORDER BY list_inner_product(q.x, v.x) DESC, v.vec_id
               ) AS rank,
               v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
        FROM v AS q JOIN v ON v.vec_id <> q.vec_id
        WHERE q.vec_id % 100 = 0 QUALIFY rank <= 10
    """,
    "op12_collocations": f"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
                {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')), '[^ \\t]+') AS words
            FROM documents
        ), totals AS (
            SELECT lang, sum(len(words))::BIGINT AS n FROM p GROUP BY lang
        ), g AS (
            SELECT lang, k, words, unnest(range(1, len(words) - k + 2)) AS i
            FROM p, range(1, 6) AS t(k)
        ), f AS (
            SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS a
            FROM g GROUP BY ALL HAVING count(*) >= 100
        ), c AS (
            SELECT *, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS cut FROM f WHERE k > 1
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, cut,
                   ((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
            FROM c JOIN totals USING (lang)
            JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:cut], ' ')
            JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')
        ), low AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inside AS (
            SELECT f.lang, f.a, string_split(f.phrase, ' ') AS words, s, m
            FROM f, range(1, 5) AS t(s), range(2, 5) AS u(m) WHERE m < f.k AND s + m - 1 <= f.k
        ), covered AS (
            SELECT lang, array_to_string(words[s:s + m - 1], ' ') AS phrase, max(a) AS longer
            FROM inside GROUP BY ALL
        ), kept AS (
            SELECT low.* FROM low LEFT JOIN covered USING (lang, phrase)
            WHERE longer IS NULL OR longer < a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept QUALIFY rank <= 2000
    """,
    "op13_hard_negatives": f"""
        WITH v AS ({_WHOLE.format(scale=256, more=", CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")}
            AND label IS NOT NULL
        ), s AS (
            SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same,
                   list_inner_product(a.x, v.x)::BIGINT AS score
            FROM v AS a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT * FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, p.vec_id AS positive_id,
               row_number() OVER (
                   PARTITION BY anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id
               ) AS rank,
               s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
        QUALIFY rank <= 10
    """,
}
