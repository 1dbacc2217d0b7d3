"""Corpus preparation as a chain of stages, each written as Parquet and read again as the next one's documents.

1. quality rules: documents outside the compression bands, too short or too repetitive go;
2. line dedup: runs of lines that stand at an earlier place too are cut from the texts; documents go that nothing is left of;
3. near duplicates: one document of each component stays;
4. decontamination: documents that hold a benchmark item go;
5. byte-level BPE: token counts and digests of the ids and of what they decode to.

All stages but the last return the columns of ``documents``, whatever they are. Every stage works on all rows
of its predecessor. An empty table passes through; null and empty texts fail the first stage; very long texts are read
whole. Of repeated rows, and of equal texts with different ids, the least id is left: line dedup empties the later
ones, and rows alike in id and text become one in the third stage. Columns of any other name stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veilgrid.llm import bpe, common, compression, decontaminate, line_dedup, near_dup, queries


#: Pre-tokens remembered by a worker in the last stage: few, as workers go on to serve other stages.
REMEMBERED = 100_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tune(spark)
    return compression.keep(docs)


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tune(spark)
    return line_dedup.dedup(docs, line_dedup.RUNS, drop_emptied=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tune(spark)
    return near_dup.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tune(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.tune(spark)
    return bpe.digest(docs, *queries.tokenizer(), remembered=REMEMBERED)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_chunks), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

#: The compression bands and the similarity join are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
