"""A training corpus from raw documents: five stages, each an operator whose decisions take effect.

Every stage takes the Parquet table that the one before it wrote and returns the table that the
next one reads. All but the last keep the columns of ``documents``, further ones included, whatever
their names.

Defined results: a null text counts as empty throughout; it is not toxic, is the near copy of every other
text without words, holds no personal data, and has no size, so the mix, which takes words, repeats it
as often as whole epochs of its source; null and repeated ids and sources are handled as the
operators say; a stage without rows gives an empty table of the same columns, and so does the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import bpe, mixing, pii, simhash, toxicity
from folioscope.llm.queries import public_vocabulary
from folioscope.plans.registry import query, table
from folioscope.session import stable


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold of the operator."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.filter(F.col("tox_score") < toxicity.THRESHOLD).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of personal data replaced by its kind."""
    # candidates are found once, for the training and for the masking
    found = stable(pii.find_spans(docs))
    spans = pii.settle(F.col("pii_spans"), pii.train(found.select("pii_spans")))
    masked = pii.redact(F.col("text"), spans)
    return (
        found.withColumn("text", masked)
        .withColumn(
            "n_chars",
            F.when(F.size("pii_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")),
        )
        .select(docs.columns)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix(docs).filter("mix_copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))
    return mixed.select(*docs.columns, copies.alias("mix_copy")).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), public_vocabulary())
    return encoded.selectExpr(
        "doc_id",
        "lang",
        "source",
        "bpe_n AS n_tokens",
        "bpe_ids AS ids",
        "bpe_ids_sha256 AS ids_sha256",
        "bpe_decoded_sha256 AS decoded_sha256",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

# Fingerprints, segment statistics and token ids are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


@query("pipeline", ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
