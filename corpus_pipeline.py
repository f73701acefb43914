"""The corpus pipeline: each stage works on all that the stage before it kept.

Quality classifier (rejected documents go), SimHash near-duplicates (one document of each group stays), benchmark
decontamination (contaminated documents go), personal data (spans are replaced by their kind), BPE encoding.
Every stage but the last returns the columns of documents; between stages the rows are written as Parquet and read
again, so a lost executor costs no earlier stage. Near-duplicates are texts of 0.8 similarity in five-word shingles.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bpe, decontaminate, pii, quality_classifier, simhash
from sluice.llm.common import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.kept(docs, quality_classifier.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("personal_data", personal_data), ("encoding", encoding)]

#: Learnt scores, XXH64 fingerprints and BPE have no SQL form. Tests compare the groups of near-duplicates with all pairs,
#: contaminated documents with a tiling of each with each item, ids with the tokenizers library; the classifier's
#: decisions with held-out labels, and personal data by what a second search finds.
ORACLE_SQL = None


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's rows are written to the folder of spark.checkpoint.dir.

    A stage's folder is deleted once the next stage is written. The last one stays, as the result reads it.
    """
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            _delete(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
