"""The registered queries of the operators: one per operator, over whole tables, and their SQL."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from . import (bpe, collocations, fingerprints, licenses, lm_scoring, minhash, mixing, periodic, quality, secrets,
               sharding, suffix_dedup, toxicity)

SHARDS = 24


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fingerprints.compare_neighbours(documents(spark, sf_dir))
    return pairs.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        fingerprints.distinct(F.col("sketch")).alias("n_shingles"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``key``: the shard follows from doc_id and the number of shards."""
    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(content) + 8).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"))
    placed = sharding.with_shards(rows, "doc_id", SHARDS, ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         "slot", "grown_shard")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    placed = mixing.with_copies(rows)
    return placed.select("doc_id", "size", "source_size", "target",
                         (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return bpe.read_tokenizer(public_tokenizers.path(name))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), tokenizer())


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owners are sources; an owner's repositories are its languages."""
    found = secrets.scan(documents(spark, sf_dir),
                         repository=F.concat_ws("/", "source", "lang"))
    base = F.filter("found", lambda s: s["kind"] < len(secrets.PATTERNS))

    def count(kind: int):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    live = F.filter("found", lambda s: s["live"])
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("found")).alias("spans"), secrets.listed(live).alias("live_spans"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", F.size("licences").cast("bigint").alias("n_matches"),
        F.array_join(F.transform("licences", lambda x: F.concat_ws(":", x["line"].cast("string"), x["licence"])), ",").alias("licences"),
        F.array_join(F.array_sort(F.array_distinct("licences.licence")), ",").alias("names"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), n=4)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what ``labels`` calls good."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    judged = quality.judge(documents(spark, sf_dir), trusted)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "ratio")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold 2 of 4 is held out: the model never sees its labels."""
    docs = documents(spark, sf_dir)
    out = toxicity.held_out(F.col("doc_id"), 4, 2)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(~out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases."""
    found = collocations.phrases(documents(spark, sf_dir).select("lang", "text"))
    return collocations.ranked(found, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def repeated_tail(key: int | None, n: int) -> np.ndarray | None:
    """Of each tenth key the words from some place on are its first few, over and over."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return place


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(documents(spark, sf_dir), order=repeated_tail)
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.reduce("runs", none, lambda top, run: F.when(
        top.isNull() | (run["length"] * top["period"] > top["length"] * run["period"]), run).otherwise(top))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(
        ",", run["start"].cast("string"), run["length"].cast("string"), run["period"].cast("string")), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_sharding, op3_mixing, op4_bpe, op5_secrets, op6_licenses, op7_suffix_dedup, op8_near_duplicates, op9_lm_scoring, op10_quality,
                                 op11_toxicity, op12_collocations, op13_periodic_runs)}
ORACLES: dict[str, str] = {
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER (ORDER BY source_size * 1.0 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
         sum(w) OVER (ORDER BY source_size * 1.0 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM sums),
level AS (
  SELECT total - fixed AS rest, share FROM ranked
  WHERE 3 * source_size * share >= (total - fixed) * w ORDER BY source_size * 1.0 / w, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), CAST(rest AS DOUBLE) * w / CAST(share AS DOUBLE)) AS target
  FROM sums, level),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.source,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(floor(rate) AS BIGINT) + CAST(
    CAST(('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '\N')), 1, 13)) AS BIGINT) / 4503599627370496.0
    < rate - floor(rate) AS BIGINT) AS copies FROM rated)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM counted""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) AS phrase
  FROM listed, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS above FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM candidates WHERE k = 3)
  GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut,
         array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:c.k], ' ') AS rest
  FROM candidates c, (VALUES (1), (2)) AS places(cut) WHERE cut < c.k),
rated AS (
  SELECT c.lang, c.phrase, c.a, c.cut, h.f AS l, t.f AS r,
         CAST(1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head AND h.k = c.cut
  JOIN f t ON t.lang = c.lang AND t.phrase = c.rest AND t.k = c.k - c.cut),
best AS (
  SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase
  WHERE x.above IS NULL OR 100 * x.above < 50 * b.a),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN totals USING (lang) WHERE rank <= 2000""",
}
