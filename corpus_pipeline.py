"""A corpus pipeline of five stages, from quality rules to token ids.

Each stage is (name, function) and a function takes (spark, docs, sf_dir); docs is the
stage before, written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loomcorpus.llm import decision_list, line_runs, lsh_forest, mixing, sp_viterbi
from loomcorpus.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decision_list.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(docs, across_blanks=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lsh_forest.drop_near_duplicates(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sp_viterbi.encode_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_to_targets),
    ("sentencepiece", encode),
]

#: The fitted rules and rates and the token ids have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir.

    What is between them goes to the shared folder; a stage's input is deleted when its
    output is written, but for that of the last, which the result reads. Null ids and texts, repeated
    rows and empty tables pass as each stage's operator says.
    """
    at = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{at}/{k}")
            docs = spark.read.parquet(f"{at}/{k}")
            if k:
                files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{k - 1}"), True)
    return docs
