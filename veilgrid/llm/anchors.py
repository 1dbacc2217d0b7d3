"""Where equal windows meet: content-defined anchors, segments, and groups of documents of bounded size.

The anchor of a window of ``length`` units is its least k-gram by hash, the leftmost on ties. Equal windows have equal
anchors at equal places, so windows only need comparing with those of the same anchor. Windows in a row mostly share
their anchor; such a run is a segment, and one segment travels instead of all its windows.

Three rounds, each between groups of documents (``group_bytes`` of text each) and buckets of anchors:

1. each group names its distinct anchors; a bucket answers which of them occur more than once anywhere;
2. each group sends its distinct segments at such anchors, once however often the group holds them; a bucket decides
   for each window of each segment and answers with a bit;
3. each group works out its segments again and applies the answers to all places it has them at.

A passage that a third of all documents share therefore reaches its bucket once from each group, not once from each
document. Groups depend on row keys alone, so lost tasks work out the same again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .decontaminate import mixed

U = np.uint64
TOP = U(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Shape:
    """Windows of ``length`` units, anchors of ``gram`` units; ``one_in``: grams hashed under this share are tried first."""

    length: int
    gram: int
    one_in: int = 1
    piece: int = 1 << 19
    group_bytes: int = 4 << 20
    task_bytes: int = 64 << 20
    bucket_bytes: int = 8 << 20

    @property
    def grams(self) -> int:
        return self.length - self.gram + 1


def _previous(c: np.ndarray, v: np.ndarray, reach: int) -> np.ndarray:
    """For each candidate the nearest earlier one, nearer than ``reach``, with no greater value; -1 if none."""
    out = np.full(len(c), -1, np.int64)
    active, j = np.arange(1, len(c)), 1
    while len(active):
        q = active - j
        near = c[active] - c[q] < reach
        active, q = active[near], q[near]
        hit = v[q] <= v[active]
        out[active[hit]] = q[hit]
        active = active[~hit]
        j += 1
        active = active[active >= j]
    return out


def _next(c: np.ndarray, v: np.ndarray, reach: int) -> np.ndarray:
    """For each candidate the nearest later one with a smaller value; ``len(c)`` if none is near."""
    n = len(c)
    out = np.full(n + 1, n, np.int64)
    active, j = np.arange(n - 1), 1
    while len(active):
        q = active + j
        near = c[q] - c[active] < reach
        active, q = active[near], q[near]
        hit = v[q] <= v[active]
        out[active[hit]] = q[hit]
        active = active[~hit]
        j += 1
        active = active[active < n - j]
    for _ in range(reach.bit_length() + 1):  # equal values hand on what comes after them
        same = np.flatnonzero(out[:-1] < n)
        same = same[v[out[same]] == v[same]]
        if not len(same):
            break
        out[same] = out[out[same]]
    return out[:-1]


def runs(h: np.ndarray, low: np.ndarray, high: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Piece, first and last window and anchor place of each run of windows with one anchor.

    ``h`` has a gram's hash for each place of the joined pieces [low, high); grams that leave a piece are ignored.
    """
    w, k = shape.grams, shape.gram
    bad = (high[:, None] - np.arange(1, k)).ravel() if k > 1 else np.zeros(0, np.int64)
    if shape.one_in > 1:
        mask = h < U((1 << 64) // shape.one_in)
        at = np.flatnonzero(mask)
        ends = np.concatenate([[-1], at, [len(h)]])
        for i in np.flatnonzero(np.diff(ends) > w).tolist():  # too long without one: all grams count there
            mask[ends[i] + 1 : ends[i + 1]] = True
    else:
        mask = np.ones(len(h), bool)
    mask[bad[bad < len(h)]] = False
    c = np.flatnonzero(mask)
    if not len(c):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    v = h[c]
    before, after = _previous(c, v, w), _next(c, v, w)
    first = np.where(before >= 0, c[before] + 1, -1)
    last = np.where(after < len(c), c[np.minimum(after, len(c) - 1)] - w, np.int64(1) << 60)
    piece = np.searchsorted(low, c, "right") - 1
    s = np.maximum(np.maximum(c - w + 1, first), low[piece])
    e = np.minimum(np.minimum(c, last), high[piece] - shape.length)
    keep = s <= e
    return piece[keep], s[keep], e[keep], c[keep]


@dataclass
class Segments:
    """Segments of some rows: row, first window, windows, anchor, and a key of the whole content with the anchor's place."""

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    key: np.ndarray


def segments(rows: list[np.ndarray], grams: Callable[[np.ndarray], np.ndarray], shape: Shape) -> Segments:
    """All segments of the rows; long rows go in pieces, short ones are joined."""
    parts: list[tuple[np.ndarray, ...]] = []
    todo: list[tuple[int, int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if todo:
            sizes = np.array([len(x) for _, _, x in todo])
            high = np.cumsum(sizes)
            low = high - sizes
            h = grams(np.concatenate([x for _, _, x in todo]))
            piece, s, e, c = runs(h, low, high, shape)
            key, end = mixed(h[c] + (e - s).astype(U) * U(0x9E3779B1) + (c - s).astype(U)), e + shape.length - shape.gram
            for j in range(0, int((end - s).max(initial=0)) + shape.gram, shape.gram):  # grams that cover the content
                key = mixed(key ^ h[np.minimum(s + j, end)])
            row, off = np.array([r for r, _, _ in todo]), np.array([o for _, o, _ in todo])
            parts.append((row[piece], s - low[piece] + off[piece], e - s + 1, h[c], key))
        todo.clear()
        held = 0

    for r, x in enumerate(rows):
        for a in range(0, len(x) - shape.length + 1, shape.piece):
            todo.append((r, a, x[a : a + shape.piece + shape.length - 1]))
            held += len(todo[-1][2])
            if held >= shape.piece:
                flush()
    flush()
    joined = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64 if i < 3 else U) for i in range(5)]
    return Segments(*joined)


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All of start..start+length-1 for each pair, one after another."""
    total = int(length.sum())
    return np.arange(total) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)


def by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, with the places that have it."""
    order = np.argsort(bucket, kind="stable")
    ids, first = np.unique(bucket[order], return_index=True)
    for b, a, z in zip(ids.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        yield b, order[a:z]


class Method:
    """What an operator adds. ``units`` makes a row of units from a text; ``grams`` hashes them (same length)."""

    shape: Shape

    def units(self, body: bytes) -> np.ndarray:
        raise NotImplementedError

    def grams(self, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def several(self, first: np.ndarray, which: np.ndarray, row: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """For each distinct anchor, whether the group alone has it often enough."""
        raise NotImplementedError

    def solve(self, parts: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
        """For each part of a bucket a flag for each window of its segments."""
        raise NotImplementedError

    def result(self, doc: list, bodies: list[bytes], units: list[np.ndarray], removed: list[np.ndarray | None]) -> dict[str, list]:
        """Output columns after ``doc_id``; ``removed`` masks units."""
        raise NotImplementedError

    #: The DDL of the columns that ``result`` gives.
    columns: str
    #: Whether a removed window must also start in a smaller document; else anywhere else.
    ordered: bool
    #: Type of the units as they travel.
    unit_type: type


LAST = np.int64((1 << 63) - 1)

#: A shuffle has tasks x tasks blocks; beyond this number tasks get longer, not larger in memory.
MOST_TASKS = 50_000


def _documents(t: pa.Table) -> tuple[list, np.ndarray, list[bytes]]:
    """Ids, ids as numbers (null: after all others) and bodies, in an order that only depends on the rows."""
    t = t.sort_by([("row", "ascending"), ("doc_id", "ascending")])
    ids = t.column("doc_id").to_pylist()
    return ids, np.array([LAST if i is None else i for i in ids], np.int64), t.column("body").to_pylist()


def apply(df: DataFrame, method: Method) -> DataFrame:
    """Remove from each text what the method's windows cover; one row for each input row."""
    shape = method.shape
    spark = df.sparkSession
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    size = rows.agg(F.sum(F.length("body") + 16).alias("n")).first()["n"] or 0
    groups, buckets = max(1, -(-int(size) // shape.group_bytes)), max(1, -(-int(size) // shape.bucket_bytes))
    # tasks by bytes, for groups and for buckets, whatever the session's number of shuffle partitions; a task holds one group or bucket at a time
    tasks = max(common.partitions(spark), min(-(-int(size) // shape.task_bytes), MOST_TASKS))
    # the row key spreads rows evenly; rows alike in id and text go to one group, which tells them apart by place
    row = F.xxhash64("doc_id", "body")
    docs = rows.select(F.pmod(row, F.lit(groups)).alias("g"), row.alias("row"), "doc_id", "body").repartition(tasks, "g")

    def local(t: pa.Table) -> tuple:
        ids, doc, bodies = _documents(t)
        units = [method.units(b) for b in bodies]
        return ids, doc, bodies, units, segments(units, method.grams, shape)

    def ask(key: tuple, t: pa.Table) -> pa.Table:
        _, doc, _, _, seg = local(t)
        anchor, first, which = np.unique(seg.anchor, return_index=True, return_inverse=True)
        flag = method.several(first, which, seg.row, doc)
        packed = (anchor & ~U(1)) | flag.astype(U)
        out = [(b, key[0].as_py(), packed[at].tobytes()) for b, at in by_bucket((anchor >> U(1)) % U(buckets), buckets)]
        return pa.table({"b": pa.array([x[0] for x in out], pa.int64()), "g": pa.array([x[1] for x in out], pa.int64()), "blob": pa.array([x[2] for x in out], pa.binary())})

    def answer(key: tuple, t: pa.Table) -> pa.Table:
        g = t.column("g").to_pylist()
        blobs = [np.frombuffer(x, U) for x in t.column("blob").to_pylist()]
        all_ = np.concatenate(blobs)
        order = np.argsort(all_ >> U(1), kind="stable")
        bare = (all_ >> U(1))[order]
        new = np.concatenate([[True], bare[1:] != bare[:-1]])
        at = np.flatnonzero(new)
        many = (np.diff(np.concatenate([at, [len(bare)]])) > 1) | (np.bitwise_or.reduceat(all_[order] & U(1), at) > 0)
        yes = np.zeros(len(all_), bool)
        yes[order] = np.repeat(many, np.diff(np.concatenate([at, [len(bare)]])))
        ends = np.cumsum([len(x) for x in blobs])
        out = [(i, x[y].tobytes()) for i, x, y in zip(g, blobs, np.split(yes, ends[:-1]), strict=True) if y.any()]
        return pa.table({"g": pa.array([x[0] for x in out], pa.int64()), "blob": pa.array([x[1] for x in out], pa.binary())})

    def distinct(seg: Segments, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, a place of each, which key each segment has, its least document, and how often it occurs."""
        key, first, which, n = np.unique(seg.key, return_index=True, return_inverse=True, return_counts=True)
        least = np.full(len(key), LAST)
        np.minimum.at(least, which, doc[seg.row])
        return key, first, which, least, n

    def send(key: tuple, t: pa.Table, said: pa.Table) -> pa.Table:
        names = ("b", "g", "key", "anchor", "count", "doc", "units")
        types = (pa.int64(), pa.int64(), *(pa.binary(),) * 5)
        out: list[tuple] = []
        if said.num_rows and t.num_rows:
            _, doc, _, units, seg = local(t)
            repeated = np.sort(np.concatenate([np.frombuffer(x, U) for x in said.column("blob").to_pylist()]) >> U(1))
            keys, first, _, least, _ = distinct(seg, doc)
            mine = seg.anchor[first] >> U(1)
            there = repeated[np.minimum(np.searchsorted(repeated, mine), len(repeated) - 1)] == mine
            keys, first, least = keys[there], first[there], least[there]
            offsets = np.cumsum([0, *(len(x) for x in units)])
            flat = np.concatenate(units)
            begin = offsets[seg.row[first]] + seg.start[first]
            for b, at in by_bucket((seg.anchor[first] >> U(1)) % U(buckets), buckets):
                n = seg.count[first[at]]
                content = flat[spread(begin[at], n + shape.length - 1)].astype(method.unit_type)
                out.append((b, key[0].as_py(), keys[at].tobytes(), seg.anchor[first[at]].tobytes(), n.astype(np.uint32).tobytes(), least[at].tobytes(), content.tobytes()))
        return pa.table({n: pa.array([x[i] for x in out], y) for i, (n, y) in enumerate(zip(names, types, strict=True))})

    def decide(key: tuple, t: pa.Table) -> pa.Table:
        kinds = {"key": U, "anchor": U, "count": np.uint32, "doc": np.int64, "units": method.unit_type}
        columns = {n: t.column(n).to_pylist() for n in ("g", *kinds)}
        parts = [{n: np.frombuffer(columns[n][i], k) for n, k in kinds.items()} for i in range(t.num_rows)]
        out = []
        for g, part, flags in zip(columns["g"], parts, method.solve(parts), strict=True):
            count = part["count"].astype(np.int64)
            some = np.add.reduceat(flags.astype(np.int64), np.cumsum(count) - count) > 0
            if some.any():
                out.append((g, part["key"][some].tobytes(), np.packbits(flags[np.repeat(some, count)]).tobytes()))
        return pa.table({"g": pa.array([x[0] for x in out], pa.int64()), "key": pa.array([x[1] for x in out], pa.binary()), "bits": pa.array([x[2] for x in out], pa.binary())})

    def finish(key: tuple, t: pa.Table, said: pa.Table) -> pa.Table:
        ids, doc, bodies, units, seg = local(t)
        lengths = np.array([len(x) for x in units], np.int64)
        offsets = np.cumsum(lengths) - lengths
        change = np.zeros(int(lengths.sum()) + 1, np.int64)
        if len(seg.key):
            keys, first, which, least, n = distinct(seg, doc)
            begin = offsets[seg.row] + seg.start
            whole = doc[seg.row] > least[which] if method.ordered else n[which] > 1
            np.add.at(change, begin[whole], 1)
            np.add.at(change, (begin + seg.count - 1 + shape.length)[whole], -1)
            rest = np.flatnonzero(~whole)
            told, flags = [], []
            for said_key, said_bits in zip(said.column("key").to_pylist(), said.column("bits").to_pylist(), strict=True):
                told.append(np.searchsorted(keys, np.frombuffer(said_key, U)))
                flags.append(np.unpackbits(np.frombuffer(said_bits, np.uint8), count=int(seg.count[first[told[-1]]].sum())))
            if told:
                at, bits = np.concatenate(told), np.concatenate(flags).astype(bool)
                count = seg.count[first[at]]
                where = np.full(len(keys), -1, np.int64)  # by key, where its flags begin
                where[at] = np.cumsum(count) - count
                who = rest[where[which[rest]] >= 0]
                windows = spread(begin[who], seg.count[who])[bits[spread(where[which[who]], seg.count[who])]]
                np.add.at(change, windows, 1)
                np.add.at(change, windows + shape.length, -1)
        covered = np.cumsum(change[:-1]) > 0
        masks = [covered[a : a + n] if covered[a : a + n].any() else None for a, n in zip(offsets.tolist(), lengths.tolist(), strict=True)]
        out = method.result(ids, bodies, units, masks)
        return pa.table({"doc_id": pa.array(ids, pa.int64())} | {n: pa.array(v, final.field(n).type) for n, v in out.items()}, schema=final)

    final = common.pa_schema("doc_id long, " + method.columns)
    asked = docs.groupBy("g").applyInArrow(ask, "b long, g long, blob binary").repartition(tasks, "b")
    answered = asked.groupBy("b").applyInArrow(answer, "g long, blob binary").repartition(tasks, "g")
    sent = docs.groupBy("g").cogroup(answered.groupBy("g")).applyInArrow(send, "b long, g long, key binary, anchor binary, count binary, doc binary, units binary").repartition(tasks, "b")
    decided = sent.groupBy("b").applyInArrow(decide, "g long, key binary, bits binary").repartition(tasks, "g")
    return docs.groupBy("g").cogroup(decided.groupBy("g")).applyInArrow(finish, "doc_id long, " + method.columns)
