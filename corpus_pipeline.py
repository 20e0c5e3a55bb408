"""The corpus run: documents in, packed training sequences out.

Each stage works on all rows its predecessor kept. What a stage returns is written as Parquet and
read again as the next one's documents, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainlake.llm.decontaminate import clean
from chainlake.llm.language_id import known_language, train
from chainlake.llm.packing import pack
from chainlake.llm.queries import bpe_50k, known_words
from chainlake.llm.secret_scan import redact, scan
from chainlake.llm.simhash import one_of_each
from chainlake.session import release, settle, tune


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents without a letter (`und`) go; an unlearned language stays under a learned one."""
    tune(spark)
    return known_language(docs, train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each set of linked fingerprints stays, the one of smallest id."""
    tune(spark)
    return one_of_each(docs, shingle=3, budget=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark passage go."""
    tune(spark)
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: secrets are replaced in the texts; n_chars follows. Every document stays."""
    tune(spark)
    found = settle(scan(docs, known_words()))
    release(spark)
    return redact(docs, found, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the pieces of all documents in sequences of 2048 tokens."""
    tune(spark)
    return pack(docs, bpe_50k())


STAGES = [("language", language), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]
# SQL can express neither the trained models nor the fingerprints nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
