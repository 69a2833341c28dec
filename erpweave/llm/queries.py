"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erpweave.llm import collocations, fingerprints, jaccard_join, mixing, packing, pii, quality_classifier, quality_rules, spelling, suffix_tree, token_counts, toxicity, url_rules
from erpweave.session import materialize

URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pii_skip_chain(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(_table(spark, folder, "documents"))


def op2_weighted_fair_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.schedule(docs, carry=["doc_id"]).select("_row.doc_id", "size", "source_size", "target", "taken")


def op3_weak_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(quality_rules.measured(_table(spark, folder, "documents")), "quality-measures")
    return quality_rules.judge(table).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op4_swap_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


def op5_weak_label_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classified(_table(spark, folder, "documents"))


def op6_suffix_tree_score(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.scored(_table(spark, folder, "documents"))


def op7_url_range_rules(spark: SparkSession, folder: str) -> DataFrame:
    names = ("host", "path", "verdict")
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule, strict=True)]) for rule in URL_RULES])
    return url_rules.judge(_table(spark, folder, "pages"), spark.range(1).select(F.inline(listed)))


def op8_simhash_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    prints = materialize(fingerprints.fingerprinted(_table(spark, folder, "documents")), "simhash")
    asked = prints.where("doc_id % 100 = 0")
    near = fingerprints.within_radius(asked, prints).groupBy("bits").agg(F.sum("n_near").alias("n_within"))
    counts = asked.select("bits").distinct().join(near, "bits")
    return prints.join(counts, "bits", "left").select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprints.fingerprint_text(F.col("bits")).alias("fingerprint"),
        fingerprints.fingerprint_text(F.col("edited_bits")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        fingerprints.likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
        # Other documents within 3 bits, for the query set: ids divisible by 100.
        F.when(F.col("doc_id") % 100 == 0, F.col("n_within") - 1).alias("n_near"),
    )


def op9_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.joined(_table(spark, folder, "documents"))


def op11_whole_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_skip_chain, op2_weighted_fair_mix, op3_weak_quality_rules, op4_swap_packing, op5_weak_label_classifier, op6_suffix_tree_score, op7_url_range_rules,
        op8_simhash_fingerprints, op9_toxicity_chain, op10_ngram_jaccard_join, op11_whole_token_counts, op12_spelling_variants, op13_phrase_collocations,
    )
}

SQL = {
    "op2_weighted_fair_mix": """
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
                   md5(concat(coalesce(doc_id::VARCHAR, ''), ':mix')) AS place
            FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS total FROM d GROUP BY source
        ), w AS (
            SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
                   2 * total::DOUBLE AS most FROM s
        ), f AS (
            SELECT *, most / weight AS fill FROM w
        ), l AS (
            SELECT *, (1.5 * sum(total::DOUBLE) OVER ()
                       - coalesce(sum(most) OVER (ORDER BY fill, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY fill, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM f
        ), t AS (
            SELECT source, total,
                   CASE WHEN fill < (SELECT min(fill) FROM l WHERE level <= fill) THEN most
                        ELSE (SELECT arg_min(level, fill) FROM l WHERE level <= fill) * weight END AS target
            FROM l
        ), q AS (
            SELECT d.*, t.total, t.target,
                   (sum(size) OVER (PARTITION BY d.source ORDER BY place ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        ), copies AS (
            SELECT doc_id, source, size, round * total + stop AS clock, (round * total + stop)::DOUBLE / target AS finish
            FROM q, (VALUES (0), (1)) r(round) WHERE size > 0
        ), summed AS (
            SELECT doc_id, size, (sum(size) OVER (ORDER BY finish, source NULLS LAST, clock ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
            FROM copies
        ), given AS (
            SELECT doc_id, sum(greatest(0, least(size, (SELECT floor(1.5 * sum(size))::BIGINT FROM d) - upto + size)))::BIGINT AS taken
            FROM summed GROUP BY doc_id
        )
        SELECT q.doc_id, size, total AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
        FROM q LEFT JOIN given ON given.doc_id = q.doc_id""",
    "op7_url_range_rules": """
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), p AS (
            SELECT page_id, row_number() OVER () AS line,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), r(rule_host, rule_path, verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                   ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), m AS (
            SELECT p.*, rule_host || rule_path AS rule, verdict,
                   row_number() OVER (PARTITION BY line ORDER BY length(rule_host || rule_path) DESC) AS place
            FROM p LEFT JOIN r ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE place = 1""",
    "op13_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
        ), g AS (
            SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM w, generate_series(1, 5) s(k))
        ), c AS (
            SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING k = 1 OR count(*) >= 100
        ), total AS (
            SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang
        ), cand AS (
            SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k >= 2
        ), cuts AS (
            SELECT lang, phrase, a, ws, unnest(generate_series(1, k - 1)) AS cut FROM cand
        ), scored AS (
            SELECT u.lang, u.phrase, u.a, lp.f AS l, rp.f AS r, n, cut, ((1000::HUGEINT * u.a * n) // (lp.f::HUGEINT * rp.f))::BIGINT AS score
            FROM cuts u JOIN total t ON t.lang = u.lang
            JOIN c lp ON lp.lang = u.lang AND lp.phrase = array_to_string(ws[1:cut], ' ')
            JOIN c rp ON rp.lang = u.lang AND rp.phrase = array_to_string(ws[cut + 1:], ' ')
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inside AS (
            SELECT lang, array_to_string(ws[i:j], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(generate_series(i + 1, k)) AS j FROM (SELECT *, unnest(generate_series(1, k - 1)) AS i FROM cand WHERE k > 2))
            WHERE j - i + 1 < k GROUP BY ALL
        )
        SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
        FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
        WHERE longer IS NULL OR 100 * longer < 100 * a
        QUALIFY rank <= 2000""",
}
