"""Documents to packed token sequences: the corpus operators in a row.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  The filtering stages return the columns of their input; the last one
returns the pieces of the packed sequences.  A stage's result is written as
Parquet in the shared checkpoint folder and read again as the next one's
input.

What each stage removes: rows without any letter (no language); all but the
largest id of equal texts; all but the least id of each SimHash component;
rows contaminated by the benchmark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import decontaminate, exact_dedup, language_id, packing, simhash
from keelson.llm.common import stored, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier names: it rejects those
    without a letter.  Where no training row has a language nothing is
    learned, and that is an error rather than an empty corpus."""
    names = docs.columns
    training = language_id.training_rows(docs)
    if docs.limit(1).count() and not training.where("label is not null").limit(1).count():
        raise ValueError("no training document has a language: the language stage cannot tell any")
    plain = docs.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    found = language_id.identify(plain, training, text=f"c{names.index('text')}")
    kept = found.where(F.col("lang_pred") != language_id.UNKNOWN)
    return kept.select([F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return simhash.one_per_component(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs, packing.default_vocabulary(), with_ids=False)


STAGES = [("language_id", identified), ("exact_dedup", distinct), ("simhash_near_dedup", unlike),
          ("decontamination", uncontaminated), ("packing", packed)]

#: SQL expresses neither the classifier nor the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
