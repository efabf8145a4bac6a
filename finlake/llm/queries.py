"""The registered queries: each applies one operator to its whole table and derives the agreed columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, is_remainder, not_remainder
from .decontaminate import contamination
from .exact_dedup import exact_dedup
from .filter_audit import filter_audit
from .jaccard import similarity_classes
from .languages import languages, profiles
from .line_dedup import drop_repeated_lines
from .lm_scoring import lm_scores
from .packing import pack
from .quality import fit, quality_scores
from .registry import ORACLE, QUERIES, query, table
from .resampling import importance_resample
from .secrets import secret_spans
from .simhash import simhash_classes
from .token_counts import token_counts

__all__ = ["ORACLE", "QUERIES"]

NORMAL = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


@query("op9_exact_dedup", f"""
    WITH t AS (SELECT doc_id, {NORMAL} AS normal FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY normal) AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY normal) AS kept, sha256(normal) AS text_sha256
    FROM t""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows, by hash of the id, stand for history; the other half is the new batch."""
    found = exact_dedup(table(spark, sf_dir, "documents"), F.xxhash64("doc_id") % 2 == 0)
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op10_line_dedup", f"""
    WITH l AS (
        SELECT doc_id, i, line, translate(trim(line, {SPACE}), '{UPPER}', '{LOWER}') AS key
        FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
    frequent AS (
        SELECT key, max(doc_id) AS last_id FROM l WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id <> last_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last_id IS NULL OR doc_id = last_id), '')) AS kept_sha256
    FROM l LEFT JOIN frequent USING (key) GROUP BY doc_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), TOKENIZER).withColumnRenamed("id", "doc_id")


WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op4_decontamination", f"""
    WITH d AS (SELECT doc_id, {WORDS.format(NORMAL)} AS w FROM documents),
    b AS (SELECT item_id, {WORDS.format(NORMAL)} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS words
        FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM (SELECT item_id, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0))),
    hits AS (
        SELECT doc_id, i, m, item_id
        FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM windows)) AS g
        JOIN windows USING (m) WHERE array_to_string(g.w[g.i : g.i + m - 1], ' ') = windows.words),
    places AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM hits) GROUP BY doc_id),
    met AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(met.n, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN places USING (doc_id) LEFT JOIN met USING (doc_id)""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"), RANKS)

    def joined(spans) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        F.col("id").alias("doc_id"), number("assign").alias("n_assign"), number("access").alias("n_access"),
        number("hex").alias("n_hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), number("random").alias("n_random"),
    )


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, doc_id = table(spark, sf_dir, "documents"), F.col("doc_id")
    model = fit(docs, table(spark, sf_dir, "labels"), not_remainder(doc_id, 4, 2))
    found = quality_scores(docs, model).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", is_remainder(doc_id, 4, 2).alias("held_out"), "score", "predicted")


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, doc_id = table(spark, sf_dir, "documents"), F.col("doc_id")
    known = profiles(docs, not_remainder(doc_id, 3, 1))
    return languages(docs, known, keep=(doc_id, is_remainder(doc_id, 3, 1).alias("held_out")))


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, doc_id = table(spark, sf_dir, "documents"), F.col("doc_id")
    found = lm_scores(docs, not_remainder(doc_id, 10, 0), keep=(doc_id, is_remainder(doc_id, 10, 0).alias("held_out")))
    return found.drop("row")


@query("op5_jaccard_join")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "n_links")


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER).withColumnRenamed("id", "doc_id")


@query("op11_filter_audit", r"""
    WITH RECURSIVE
    d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    f AS (SELECT doc_id, part,
                 CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
                 + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                 + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
                 + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                 + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
          FROM d),
    g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
              FROM f LEFT JOIN g USING (doc_id) GROUP BY part, mask),
    letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    prefixes(prefix, step, before, bit) AS (
        SELECT '', 0, 0, 0
        UNION ALL
        SELECT prefix || letter, step + 1, before | prefixes.bit, letters.bit
        FROM prefixes, letters WHERE strpos(prefix, letter) = 0),
    steps AS (
        SELECT part, prefix, step, right(prefix, 1) AS letter,
               sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
               sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
               sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
        FROM prefixes, cells WHERE step > 0 GROUP BY part, prefix, step),
    orders AS (SELECT prefix AS filter_order, unnest(range(1, 6)) AS s FROM prefixes WHERE step = 5),
    whole AS (SELECT part, filter_order, steps.* EXCLUDE (part) FROM orders JOIN steps ON prefix = filter_order[1:s])
    SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM whole""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


BYTES = "list_transform(range(0, len(hex(word)) // 2), lambda i: CAST('0x' || hex(word)[2 * i + 1 : 2 * i + 2] AS UBIGINT))"


@query("op12_importance_resampling", f"""
    WITH crc AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS UBIGINT), CAST(range(8) AS UBIGINT[])),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END)) AS t),
    w AS (SELECT doc_id, unnest({WORDS.format(NORMAL)}) AS word FROM documents),
    b AS (SELECT unnest({WORDS.format(NORMAL)}) AS word FROM benchmark),
    hashed AS (
        SELECT word, xor(CAST(4294967295 AS UBIGINT), list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), {BYTES}),
               lambda c, x: xor(t[CAST(xor(c, x) & 255 AS BIGINT) + 1], c >> 8))) % 10000 AS bucket
        FROM (SELECT word FROM w UNION SELECT word FROM b), crc),
    raw AS (SELECT bucket, count(*) AS s FROM w JOIN hashed USING (word) GROUP BY bucket),
    target AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (word) GROUP BY bucket),
    totals AS (SELECT coalesce((SELECT sum(s) FROM raw), 0) AS S, coalesce((SELECT sum(t) FROM target), 0) AS T),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(target.t, 0) + 1 AS DOUBLE) * CAST(totals.S + 10000 AS DOUBLE)
               / (CAST(coalesce(raw.s, 0) + 1 AS DOUBLE) * CAST(totals.T + 10000 AS DOUBLE)))) AS BIGINT) AS gain
        FROM raw FULL JOIN target USING (bucket), totals),
    sums AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM w JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
    scored AS (
        SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
               (CAST(CAST('0x' || sha256('2024:' || CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) AS DOUBLE) + 0.5e0) / 4294967296e0))) AS BIGINT) AS score
        FROM documents LEFT JOIN sums USING (doc_id)),
    ranked AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 10 // 100 AS drawn
        FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
