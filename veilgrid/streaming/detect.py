"""Detection over streams: the same stateless plan, and counts over event time."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilgrid.operators.catalog import detect


def stream_matches(stream: DataFrame, categories: Iterable[str] | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Matches of each arriving text; columns in ``keep`` (such as the event time) come along."""
    if not keep:
        return detect(stream, categories, id_col=id_col, text_col=text_col)
    carried = stream.withColumn("_doc", F.struct(F.col(id_col).alias("id"), *keep))
    rows = detect(carried, categories, id_col="_doc", text_col=text_col)
    return rows.select(F.col("doc_id.id").alias("doc_id"), *(F.col(f"doc_id.{c}").alias(c) for c in keep), *(c for c in rows.columns if c != "doc_id"))


def once(stream: DataFrame, id_col: str, time_col: str, delay: str) -> DataFrame:
    """Each document once, however often it is delivered within the delay."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def counts(matches: DataFrame, time_col: str, delay: str, window: str, slide: str | None = None) -> DataFrame:
    """Findings of each category over tumbling or sliding windows."""
    w = F.window(time_col, window, slide) if slide else F.window(time_col, window)
    return matches.withWatermark(time_col, delay).groupBy(w.alias("w"), "category").agg(F.count("*").alias("n")).select("w.start", "w.end", "category", "n")


def sessions(matches: DataFrame, time_col: str, delay: str, gap: str, key: str) -> DataFrame:
    """Findings of each key in sessions that end after a gap."""
    return matches.withWatermark(time_col, delay).groupBy(F.session_window(time_col, gap).alias("w"), key).agg(F.count("*").alias("n")).select("w.start", "w.end", key, "n")
