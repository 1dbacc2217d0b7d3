"""Line dedup: content-defined chunks of lines; globally repeated multi-line chunks go after byte comparison.

A rolling hash over the hashes of the last ``window`` lines ends a chunk where it is divisible by ``divisor``,
so boundaries depend on content alone and shift with inserted or deleted lines. A chunk has ``least`` to ``most``
lines and at least ``words`` words. Of equal chunks the first stays, by document id, row key and place; the
others' lines are removed.

With ``runs`` every run of ``least`` lines and ``words`` words that also stands at an earlier place goes, wherever chunks
would begin. The pieces compared are then the shortest runs from each line on and up to each line: any longer
repeated run is covered by them, so nothing depends on boundaries. The first place of a line always stays.

Equal 128-bit hashes only propose: chunks are grouped by hash and by their bytes, and where texts with one hash
differ, nothing with that hash is removed. The grouping combines before it shuffles, so a chunk that
a third of all documents hold arrives once from each task; the join back is a plain join that adaptive
execution splits where one chunk is frequent.

Cases: a null text stays null. Empty texts and one-line texts stay as they are, and very long texts are read whole. A document
all of whose lines go keeps an empty text. Rows with the same id and text count as one place and are treated alike: what
they repeat among themselves stays. Null ids come first. An empty table gives an empty one. Other columns stay, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Settings:
    window: int = 2
    divisor: int = 3
    least: int = 2
    most: int = 16
    words: int = 8
    runs: bool = False


DEFAULT = Settings()
RUNS = Settings(runs=True)
MASK = (1 << 64) - 1
FACTOR = 0x9E3779B97F4A7C15


def chunks(lines: list[bytes], settings: Settings = DEFAULT) -> list[tuple[int, int]]:
    """(first line, line after the last) of each chunk of a text, in order; all lines are in one chunk."""
    out, start, rolled = [], 0, 0
    hashes = [xxhash.xxh3_64_intdigest(x) for x in lines]
    drop = pow(FACTOR, settings.window, 1 << 64)
    for i, h in enumerate(hashes):
        gone = hashes[i - settings.window] if i >= settings.window else 0
        rolled = (rolled * FACTOR + h - gone * drop) & MASK
        long = i + 1 - start
        if long >= settings.most or long >= settings.least and (rolled >> 17) % settings.divisor == 0:
            out.append((start, i + 1))
            start = i + 1
    if start < len(lines):
        out.append((start, len(lines)))
    return out


def shortest_runs(lines: list[bytes], settings: Settings = DEFAULT) -> list[tuple[int, int]]:
    """The shortest runs with enough lines and words from each line on and up to each line."""
    n, total = len(lines), [0]
    for x in lines:
        total.append(total[-1] + len(x.split()))
    out, stop, first = set(), 0, 0
    for i in range(n - settings.least + 1):
        stop = max(stop, i + settings.least)
        while stop < n and total[stop] - total[i] < settings.words:
            stop += 1
        if total[stop] - total[i] < settings.words:
            break
        out.add((i, stop))
    for stop in range(settings.least, n + 1):
        while first + 1 <= stop - settings.least and total[stop] - total[first + 1] >= settings.words:
            first += 1
        if total[stop] - total[first] >= settings.words:
            out.add((first, stop))
    return sorted(out)


def chunk_hash(chunk: bytes) -> tuple[int, int]:
    """128 bits of a chunk, as two numbers."""
    h = xxhash.xxh3_128_intdigest(chunk)
    return (h >> 64) - (1 << 63), (h & MASK) - (1 << 63)


def _found(rows: DataFrame, settings: Settings, with_text: bool) -> DataFrame:
    """Multi-line chunks, or shortest runs, of all texts: hash, row, place, and their bytes if asked for."""
    schema = "h1 long, h2 long, doc_id long, r1 long, r2 long, first long, stop long" + (", chunk binary" if with_text else "")
    types = common.pa_schema(schema)
    pieces = shortest_runs if settings.runs else chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in types]
            for d, r1, r2, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = body.split(b"\n")
                if len(lines) < settings.least:
                    continue
                for a, b in pieces(lines, settings):
                    chunk = b"\n".join(lines[a:b])
                    if b - a < settings.least or len(chunk.split(None, settings.words)) < settings.words:
                        continue
                    values = [*chunk_hash(chunk), d, r1, r2, a, b, chunk]
                    for column, v in zip(out, values, strict=False):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(out, types, strict=True)], schema=types)

    return rows.mapInArrow(run, schema)


def removed(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``r1``, ``r2`` and the line ranges to remove from the row they name; rows without any are absent."""
    r1, r2 = common.row_key("doc_id", "text")
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), r1.alias("r1"), r2.alias("r2"), body.alias("body"))
    place = F.struct("doc_id", "r1", "r2", "first")
    texts = _found(rows, settings, True).groupBy("h1", "h2", "chunk").agg(F.min(place).alias("kept"), F.max(place).alias("last"))
    # no chunk texts from here on; a hash with two texts is left alone
    repeated = texts.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.first("kept").alias("kept"), F.first("last").alias("last")).where("n = 1 and kept <> last").select("h1", "h2", "kept")
    repeated = common.stored(repeated, "repeated-chunks")  # as a table of its own: the join below can then split a frequent chunk
    gone = _found(rows, settings, False).join(repeated, ["h1", "h2"]).where(~place.eqNullSafe(F.col("kept")))
    lines = F.flatten(F.collect_list(F.sequence("first", F.col("stop") - 1)))  # line by line, as runs overlap
    ranges = F.transform(F.sort_array(F.array_distinct(lines)), lambda i: F.struct(i.alias("first"), (i + 1).alias("stop")))
    return gone.select("r1", "r2", "first", "stop").distinct().groupBy("r1", "r2").agg(ranges.alias("gone"))


def _marked(df: DataFrame, settings: Settings) -> tuple[DataFrame, str]:
    """The table with the ranges to remove in a column of a free name."""
    one, two, cut = common.free(df, "row1", "row2", "gone")
    r1, r2 = common.row_key("doc_id", "text")
    gone = removed(df, settings).select(F.col("r1").alias(one), F.col("r2").alias(two), F.col("gone").alias(cut))
    return df.withColumns({one: r1, two: r2}).join(gone, [one, two], "left"), cut


def _without(text, first, stop):
    """The text without the lines of some ranges."""
    out = []
    for t, a, b in zip(text.to_pylist(), first.to_pylist(), stop.to_pylist(), strict=True):
        if t is None or not a:
            out.append(t)
            continue
        lines, kept, at = t.split("\n"), [], 0
        for x, y in zip(a, b, strict=True):
            kept += lines[at:x]
            at = y
        out.append("\n".join(kept + lines[at:]))
    return pa.array(out, pa.string())


def dedup(df: DataFrame, settings: Settings = DEFAULT, drop_emptied: bool = False) -> DataFrame:
    """The documents with all their columns, repeated chunks cut from ``text``; ``n_chars`` follows if there.

    With ``drop_emptied`` documents go that lost all their lines to others.
    """
    joined, cut = _marked(df, settings)
    # nondeterministic, so that the length and the filter read one result, not a second run in a second worker
    text = F.arrow_udf(_without, "string").asNondeterministic()(F.col("text"), F.col(f"{cut}.first"), F.col(f"{cut}.stop"))
    out = joined.withColumn("text", F.when(F.col(cut).isNull(), F.col("text")).otherwise(text))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.length("text").cast(df.schema["n_chars"].dataType))
    if drop_emptied:
        out = out.where(F.col(cut).isNull() | (F.col("text") != ""))
    return out.select(*(f"`{c}`" for c in df.columns))


def digest(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """For each document its lines, the lines removed and a digest of what is left."""
    joined, _ = _marked(df.select("doc_id", "text"), settings)
    n = F.coalesce(F.aggregate("gone", F.lit(0).cast("long"), lambda acc, x: acc + x["stop"] - x["first"]), F.lit(0).cast("long"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.arrow_udf(_without, "string")(F.col("text"), F.col("gone.first"), F.col("gone.stop")))
    return joined.select("doc_id", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"), n.alias("n_removed"), F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("kept_sha256"))
