"""From raw documents to token files: the stages of a training-data pipeline.

Every stage reads all rows that the one before kept. Null and empty texts pass the
filters; the mix takes no copy of a text without words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.llm import decontaminate, mixing, near, tokens, toxicity
from lagscope.llm.queries import TOKENIZER, token_digests
from lagscope.llm.tables import held_out, read_table, stored
from lagscope.session import scratch_dir


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field predicts to be toxic go."""
    labels = read_table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    return toxicity.keep_civil(docs, toxicity.fit_toxicity(docs, labels))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 over five-word shingles, the one with the
    smallest id stays."""
    return near.keep_one(docs)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or left out, so that sources meet their targets."""
    return mixing.take_copies(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; per document what was read back from them."""
    files = tokens.write_tokens(docs, scratch_dir(spark, "tokens"), TOKENIZER)
    return token_digests(files, docs)


STAGES = [
    ("toxicity", keep_civil),
    ("near-dedup", keep_one_of_each),
    ("decontamination", keep_unseen),
    ("mixing", mix),
    ("tokens", write_ids),
]
#: Learned tags, hashed signatures and a tokenizer have no SQL form; tests compare each
#: stage with a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
