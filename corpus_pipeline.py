"""A corpus pipeline of five stages over `documents`: from quality to packed token ids.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame; all but the last keep the
columns of documents. Texts that decontamination or mixing cut get a new n_chars. A document mixed in twice is two rows from there on;
the last one of a source may hold only the words up to the source's budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, mixing, near_dup, pack, quality
from millrace.llm.common import materialize, table
from millrace.llm.queries import tokenizer_file
from millrace.session import ship

#: No SQL expresses the classifier, so the rows are tested against a version without it.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now; that of a null text stays."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(ship(spark), sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.dedup(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.remove_spans(docs, table(ship(spark), sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mix(docs))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack.pack(docs, tokenizer_file())


STAGES = [("quality", keep_quality), ("near_dup", drop_near_duplicates), ("decontaminate", cut_benchmark), ("mix", mix_sources), ("pack", pack_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
