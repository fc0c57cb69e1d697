"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ads_ann, bootstrap_pii, boosted_toxicity, forest_secrets, icws_dedup, label_prop_shard, line_crf, offset_tokens, qgram_decontam,
               spelling_variants, trie_phrases, vector_pack, zstd_langid)
from .common import crc_mod, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod(F.col("doc_id"), 4) != 2)
    scored = line_crf.classify(docs, line_crf.train(docs, labels), ["doc_id"])
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    learned = zstd_langid.train_dictionaries(docs, ~held_out)
    return zstd_langid.identify(docs, learned, ["doc_id"]).withColumn("held_out", held_out)


@query
def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = vector_pack.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "loss_tokens")


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return qgram_decontam.find(documents(spark, sf_dir), benchmark, ["doc_id"])


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ads_ann.search(vectors, F.col("vec_id") % 20 == 0, k=20)


@query
def op6_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_prop_shard.shard(documents(spark, sf_dir)).drop("group")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return offset_tokens.attribute(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN, ["doc_id"])


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = icws_dedup.near_duplicates(documents(spark, sf_dir))
    return rows.select("doc_id", "class_id", "class_size")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = forest_secrets.train(docs, path=F.col("source"))
    found = forest_secrets.scan(docs, model, ["doc_id"], path=F.col("source"))
    return found.select("doc_id", "start", "end", "kind", F.crc32("value").alias("value_crc32"),
                        "probability", "is_secret")


@query
def op10_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod(F.col("doc_id"), 5) != 0)
    scored = boosted_toxicity.classify(docs, boosted_toxicity.train(docs, labels), ["doc_id"])
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.count_words(documents(spark, sf_dir), damage=31)
    return spelling_variants.group_variants(words, ratio=10)


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_phrases.collocations(documents(spark, sf_dir), least=30, top=2000)


ORACLE_SQL["op12_phrase_collocations"] = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
          FROM lists, (VALUES (1), (2), (3), (4)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, g, count(*) AS a FROM grams GROUP BY lang, k, g),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
cuts AS (SELECT c.lang, c.k, c.phrase, c.g, c.a, s.k AS cut, array_to_string(c.g[1:s.k], ' ') AS lp, array_to_string(c.g[s.k + 1:], ' ') AS rp
         FROM cand c, (VALUES (1), (2), (3)) AS s(k) WHERE s.k < c.k),
scored AS (SELECT c.lang, c.k, c.phrase, c.g, c.a, c.cut, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lp JOIN f r ON r.lang = c.lang AND r.phrase = c.rp),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM cand o WHERE o.lang = b.lang AND o.k > b.k AND 100 * o.a >= 80 * b.a
      AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       t.n::BIGINT AS n, score::BIGINT AS score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bootstrap_pii.extract(documents(spark, sf_dir), ["doc_id"])
    kinds = F.transform("strict", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
              for k, name in enumerate(bootstrap_pii.KINDS)]
    return found.select("row.doc_id", *counts, F.sha2(bootstrap_pii.spelled(F.col("strict")), 256).alias("base_sha256"),
                        bootstrap_pii.spelled(F.sort_array(F.concat("strict", "found"))).alias("spans"),
                        F.size("found").cast("long").alias("n_found"))
