"""A training-data pipeline over ``documents``: language, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. What a stage decides takes effect: documents whose
language can't be told go, one document of each group of near duplicates stays,
documents that hold a benchmark passage go, secrets are replaced in the text, and
what is left becomes packed sequences.

Defined cases are those of the operators; an empty table passes through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import forest_secrets, icws_dedup, qgram_decontam, vector_pack, zstd_langid
from stratum.llm.common import documents, reliable
from stratum.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned = zstd_langid.train_dictionaries(docs, F.lit(True))
    return zstd_langid.keep_identified(docs, learned)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return icws_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return qgram_decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = forest_secrets.train(docs, path=F.col("source"))
    clean = forest_secrets.redact(docs, model, path=F.col("source"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = vector_pack.pack(docs, tokenizer_path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact_secrets", redact_secrets),
    ("pack_sequences", pack_sequences),
]

#: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each stage's result is written to the shared checkpoint folder."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = reliable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
