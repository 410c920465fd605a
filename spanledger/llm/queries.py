"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.llm import bpe, decontam, exact_dedup, filter_audit, hard_negatives, langid, packing, quality, sharding, simhash, substring, toxicity, url_filter
from spanledger.llm.shipping import ship
from spanledger.llm.textops import train_fold
from spanledger.sources.scratch import durable

URL_RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> F.Column:
    return ~train_fold(F.col("doc_id"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled urls are those that a rule decides; the model carries the rules over to the others."""
    pages = table(spark, sf_dir, "pages")
    labelled = url_filter.with_rules(pages.select("url"), URL_RULES).select("url", F.col("rule_verdict").alias("verdict"))
    return url_filter.judge_urls(pages, URL_RULES, url_filter.train(labelled))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(train_fold(F.col("doc_id"))))
    return (langid.identify(docs, model).withColumn("held_out", held_out())
            .select("doc_id", "held_out", "lang_pred", "score", "cosine", "rejected"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel | None:
    labels = table(spark, sf_dir, "labels")
    return toxicity.fit(docs.filter(train_fold(F.col("doc_id"))), labels.filter(train_fold(F.col("doc_id"))), docs)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = durable(quality.document_statistics(table(spark, sf_dir, "documents")), "document-statistics")
    model = quality.fit(stats.filter(train_fold(F.col("doc_id"))), table(spark, sf_dir, "labels"))
    return quality.score_quality(stats, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.decode_ids(bpe.encode_texts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    # A JSON list of numbers without its brackets is the decimal ids joined by commas.
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.btrim(F.to_json("ids"), F.lit("[]")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components become whole 256ths; a seventh of the ids get the next label."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").filter(finite).select("vec_id", label.alias("label"), whole.alias("vector"))
    return hard_negatives.mine_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_url_filter, op3_exact_dedup, op4_packing, op5_language, op6_toxicity,
                            op7_simhash, op8_quality, op9_sharding, op10_substring_dedup, op11_filter_audit, op12_byte_bpe, op13_hard_negatives)
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)
    """,
    "op10_substring_dedup": """
        WITH words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
            FROM words, unnest(generate_series(1, len(w) - 19)) AS s(i)),
        ranked AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS late FROM windows),
        gone AS (
            SELECT DISTINCT doc_id, i + k AS p FROM ranked, unnest(generate_series(0, 19)) AS s(k) WHERE late),
        placed AS (
            SELECT doc_id, p, w[p] AS word FROM words, unnest(generate_series(1, len(w))) AS s(p)),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)
    """,
    "op11_filter_audit": """
        WITH t AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (
            SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
                   doc_id > min(doc_id) OVER (PARTITION BY t) AS copy FROM t),
        fails AS (
            SELECT doc_id, part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
                   [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
                    regexp_matches(t, '[#$%&*|]'), copy] AS f
            FROM w LEFT JOIN labels USING (doc_id)),
        letters AS (SELECT i, chr((64 + i)::INT) AS c FROM range(1, 6) AS s(i)),
        orders AS (
            SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        steps AS (
            SELECT filter_order, k::INT AS step, o[k] AS f, o[:k - 1] AS before FROM orders, range(1, 6) AS s(k)),
        shapes AS (
            SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
            FROM fails GROUP BY part, f),
        counted AS (
            SELECT part, filter_order, step, steps.f AS filter,
                   sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
                   sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END)::BIGINT AS removed,
                   sum(CASE WHEN gone AND hit THEN n ELSE 0 END)::BIGINT AS redundant,
                   sum(CASE WHEN hit AND alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END)::BIGINT AS good_lost,
                   sum(CASE WHEN NOT gone AND hit THEN bad ELSE 0 END)::BIGINT AS toxic_lost
            FROM (SELECT part, n, good, bad, filter_order, step, steps.f, shapes.f[steps.f] AS hit,
                         len(list_filter(before, lambda x: shapes.f[x])) > 0 AS gone,
                         len(list_filter(shapes.f, lambda x: x)) = 1 AS alone
                  FROM shapes, steps) AS steps
            GROUP BY ALL)
        SELECT * EXCLUDE (filter), sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM counted
    """,
    "op13_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
        pairs AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                   list_dot_product(a.v, r.v)::BIGINT AS score
            FROM vectors a, vectors r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
        positives AS (
            SELECT * FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, p.vec_id AS positive_id,
               row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
               n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n USING (anchor_id)
        WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10
    """,
}
