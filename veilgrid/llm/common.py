"""What the text operators share: reading, Arrow batches, words and shared tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilgrid.session import kept, remove, ship

#: Rows in an Arrow batch handed to Python: texts may be long, so batches stay small.
BATCH_ROWS = 512


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table; only the columns a plan uses are read."""
    return tune(spark).read.parquet(f"{sf_dir}/documents.parquet")


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and an import path for Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return ship(spark)


def text_rows(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id`` and the text's bytes; a null text counts as empty."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit("").cast("binary")).alias("body"))


def per_document(df: DataFrame, score: Callable[[bytes], tuple], schema: str, names: list[str]) -> DataFrame:
    """Apply ``score`` to each text; one output row for each input row.

    ``schema`` has ``doc_id`` first, then what ``score`` returns, in the order of ``names``.
    """
    types = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [score(x) for x in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(types.field(0).type)] + [pa.array(c, types.field(i + 1).type) for i, c in enumerate(columns)], schema=types)

    return df.mapInArrow(run, schema)


PA_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def pa_schema(schema: str) -> pa.Schema:
    """The Arrow schema of a plain DDL string."""
    return pa.schema([(x.split()[0], PA_TYPES[x.split()[1]]) for x in schema.split(",")])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors.

    What an operator stores is removed by :func:`drop` once a later table takes its place, the rest when the driver ends.
    """
    return kept(df, name)


def drop(df: DataFrame) -> None:
    """Remove a stored table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of the table has it; Spark does not tell small letters from capitals."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(*columns: str) -> tuple[Column, Column]:
    """128 bits that name a row by some of its columns."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(0x5BD1E995), *reversed(columns))


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
