"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor kept, and returns a DataFrame; ``run``
writes each result as Parquet under the shared checkpoint folder and rereads it as the next stage's documents.  All but
the last return the columns of ``documents``.  SQL can express neither the classifier nor the forest nor the tokenizer,
so there is no oracle; tests hold the stages against brute force.

Defined cases: null and empty texts pass every filter (their score is the model's bias) and are packed as one end token; a
null ``doc_id`` is kept; of rows equal in id and text one stays, unless they have no words; very long texts are read whole;
an empty table gives an empty result; other columns pass through to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, ngram_jaccard, packing, secret_scan, toxicity
from tessera.llm.common import every, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    model = toxicity.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents (five words, 0.8) the one of smallest id stays."""
    return ngram_jaccard.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked, and ``n_chars`` follows the text."""
    masked = secret_scan.redact(docs)
    changed = F.contains("text", F.lit(secret_scan.MASK))
    return masked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*every(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces with their sequence and place."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
