"""From a model's token predictions to detections.

The model itself is a provider: any function from views to a table of token predictions
``doc_id, view_id, seq, entity, bio, start, stop, text, confidence``. Everything after it is here, in windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilgrid.functions.identifiers import id_card_kind
from veilgrid.functions.labels import ENTITIES, SEMANTIC

Provider = Callable[[DataFrame], DataFrame]
LABELS = ("O", *(f"{b}-{e}" for e in ENTITIES for b in ("B", "I")))


def enabled(scope: str = "all", entities: Iterable[str] = ()) -> tuple[str, ...]:
    """Entities in use; an explicit list wins over the scope."""
    if scope not in ("semantic", "all"):
        raise ValueError("scope must be semantic or all")
    chosen = set(entities)
    return tuple(e for e in ENTITIES if e in chosen) if chosen else SEMANTIC if scope == "semantic" else tuple(ENTITIES)


def _by_entity(entity: Column, i: int) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for e, v in ENTITIES.items() for x in (e, v[i]))), entity)


def judged(predictions: DataFrame, delta: float = 0.0, scope: str = "all", entities: Iterable[str] = ()) -> DataFrame:
    """Predictions of entities in use with their category, threshold and whether they pass it; all are kept for a trace."""
    threshold = F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), _by_entity(F.col("entity"), 1) + delta)), 6)
    rows = predictions.where(F.col("entity").isin(*enabled(scope, entities)) & (F.col("stop") > F.col("start")))
    return rows.withColumn("category", _by_entity(F.col("entity"), 0)).withColumn("threshold", threshold).withColumn("passed", F.col("confidence") >= threshold)


def detections(judged_rows: DataFrame, text_of: DataFrame | None = None, as_of: str = "2026-01-01") -> DataFrame:
    """Consecutive pieces of one category become one detection; pieces under their threshold are as if they were not there.

    Pieces join when the category stays, the next starts at most one character on, and it is tagged inside, or the
    category is a name or an address. Short ones go: under two characters, or three for an address of street and
    building alone. Confidence is the mean. Identity cards are told apart by their digits.
    """
    w = Window.partitionBy("doc_id", "view_id").orderBy("seq")
    joins = (F.lag("category").over(w) == F.col("category")) & (F.col("start") <= F.lag("stop").over(w) + 1) & ((F.col("bio") == "I") | F.col("category").isin("person_name", "address"))
    new = F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)
    marked = judged_rows.where("passed").withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    rows = marked.groupBy("doc_id", "view_id", "_run").agg(
        F.first("category").alias("category"),
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("seq", "entity"))), lambda x: x["entity"])).alias("entities"),
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "text"))).alias("_parts"),
        F.avg("confidence").alias("confidence"),
    )
    joined = F.aggregate("_parts", F.struct(F.lit("").alias("t"), F.lit(-1).alias("e")), lambda acc, x: F.struct(F.concat(acc["t"], F.when((acc["e"] >= 0) & (x["start"] > acc["e"]), " ").otherwise(""), x["text"]).alias("t"), x["stop"].cast("int").alias("e")), lambda acc: acc["t"])
    rows = rows.withColumn("text", joined)
    if text_of is not None:
        rows = rows.drop("text").join(text_of, ["doc_id", "view_id"]).withColumn("text", F.col("view_text").substr(F.col("start") + 1, F.col("stop") - F.col("start"))).drop("view_text")
    lead, trail = F.length("text") - F.length(F.ltrim("text")), F.length("text") - F.length(F.rtrim("text"))
    rows = rows.withColumn("start", (F.col("start") + lead).cast("int")).withColumn("stop", (F.col("stop") - trail).cast("int")).withColumn("text", F.trim("text"))
    least = F.when((F.col("category") == "address") & (F.size(F.array_except("entities", F.array(F.lit("STREET"), F.lit("BUILDINGNUM")))) == 0), 3).when(F.col("category").isin("person_name", "address"), 2).otherwise(1)
    category = F.when(F.col("category") == "id_card_number", id_card_kind(F.col("text"), as_of)).otherwise(F.col("category"))
    return rows.where(F.length(F.regexp_replace("text", "\\s", "")) >= least).select("doc_id", "view_id", category.alias("category"), "entities", "start", "stop", "text", "confidence", F.concat(F.lit("ner:"), F.array_join("entities", "+")).alias("rule_id"))


def distinct_inference(views: DataFrame, provider: Provider) -> DataFrame:
    """Run a provider once for each different text, then give its predictions to all views that have it."""
    keyed = views.withColumn("_text", F.sha2("text", 256))
    texts = keyed.groupBy("_text").agg(F.first("text").alias("text"))
    found = provider(texts.select(F.lit(0).cast("long").alias("doc_id"), F.xxhash64("_text").alias("view_id"), "text"))
    return keyed.select("doc_id", "view_id", F.xxhash64("_text").alias("_id")).join(found.drop("doc_id").withColumnRenamed("view_id", "_id"), "_id").drop("_id")


LOGITS = "doc_id long, view_id long, seq int, entity string, bio string, start int, stop int, text string, confidence double"


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def named_tokens(text: str, offsets: Iterable[tuple[int, int]], logits: np.ndarray, labels: tuple[str, ...] = LABELS) -> list[tuple]:
    """(seq, entity, bio, start, stop, text, confidence) of the tokens with a label: the likeliest one and its probability.

    Tokens without characters, as a model's own signs, and those outside any entity have none.
    """
    out = []
    p = softmax(np.asarray(logits, float)) if len(logits) else np.zeros((0, len(labels)))
    for (start, stop), row in zip(offsets, p, strict=True):
        best = int(row.argmax())
        if stop > start and labels[best] != "O":
            bio, entity = labels[best].split("-", 1)
            out.append((len(out), entity, bio, int(start), int(stop), text[start:stop], float(row[best])))
    return out


def logits_provider(load: Callable[[], Callable[[list[str]], list[tuple]]], labels: tuple[str, ...] = LABELS) -> Provider:
    """A provider for a model that gives offsets and logits.

    ``load`` makes the model; it runs once for each worker's stream of batches, not for each batch. The model takes texts
    and returns (offsets, logits) for each.
    """

    def provider(views: DataFrame) -> DataFrame:
        schema = pa.schema([("doc_id", pa.int64()), ("view_id", pa.int64()), ("seq", pa.int32()), ("entity", pa.string()), ("bio", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string()), ("confidence", pa.float64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = load()
            for batch in batches:
                docs, ids, texts = (c.to_pylist() for c in batch.columns)
                rows = [(d, v, *t) for d, v, text, (offsets, logits) in zip(docs, ids, texts, model(texts), strict=True) for t in named_tokens(text, offsets, logits, labels)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        return views.select(F.col("doc_id").cast("long"), F.col("view_id").cast("long"), "text").where("text is not null").mapInArrow(run, LOGITS)

    return provider


def stub_provider(views: DataFrame) -> DataFrame:
    """A stand-in for a model, without weights: capitalised words behind a title count as a name."""
    from veilgrid.functions.offsets import located

    found = located(F.col("text"), "(?<=(?:Mr|Ms|Dr)\\. )[A-Z][a-z]+")
    rows = views.select("doc_id", "view_id", F.posexplode(found).alias("seq", "m"))
    return rows.select("doc_id", "view_id", "seq", F.lit("SURNAME").alias("entity"), F.lit("B").alias("bio"), F.col("m.start").alias("start"), F.col("m.stop").alias("stop"), F.col("m.value").alias("text"), F.lit(0.9).alias("confidence"))
