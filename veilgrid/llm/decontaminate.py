"""Benchmark decontamination: SimHash fingerprints of item-sized windows, Hamming blocks, exact verification.

A document is contaminated by an item of n words when one of its windows of n words has a weighted-shingle
similarity of at least ``similarity`` with it: the sum of the smaller by the sum of the larger counts of
five-word shingles (the whole item where it is shorter). Words are runs of ASCII letters and digits and of all
characters over 0x7F, in small letters.

A window and an item without a common shingle have similarity 0, so a window only gets a fingerprint where it holds
a shingle, and is only compared with the items that have that shingle. Their fingerprints are compared through
``radius + 1`` blocks: two within the radius agree in at least one block, so no fingerprint within the radius is
missed, and each candidate is then verified on its words. The radius is wide (24 of 64 bits; about 11 differ at
similarity 0.75), so what SimHash itself could miss is about one borderline window in 100,000; at such a radius the
blocks alone prune little, and the shared shingles do most of it. A document shorter than an item is one window.

Items are a query set against all rows: they are collected in blocks of at most ``block_bytes`` of text, however
many there are, and each block is compared with every document, without a shuffle.

Cases: null and empty texts, and items without words, match nothing. Repeated documents each get their rows;
repeated items are one. Ties between windows go to the first. Very long texts are read whole, their windows some thousands
at a time. Without items, or without documents, nothing matches. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .license_scan import FOLD

U = np.uint64


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.75
    radius: int = 24
    block_bytes: int = 8 << 20
    windows_at_once: int = 2048


DEFAULT = Settings()


def words_of(body: bytes) -> list[bytes]:
    return body.decode("utf-8", "replace").lower().encode().translate(FOLD).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the word."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U, count=len(words))


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    s = np.zeros(n, U)
    for k in range(width):
        s = s * U(0x9E3779B97F4A7C15) + h[k : k + n]
    return mixed(s)


def fingerprints(s: np.ndarray, width: int) -> np.ndarray:
    """SimHash of each run of ``width`` shingles; a shingle weighs as often as it occurs."""
    bits = np.unpackbits(s.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    total = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0)])
    sums = total[width:] - total[:-width]
    return np.packbits(sums > 0, axis=1).view(U).ravel()


class HammingIndex:
    """All stored fingerprints within a radius, through blocks of which at least one must agree."""

    def __init__(self, stored: np.ndarray, radius: int):
        self.stored, self.radius = stored, radius
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = []
        for low, high in zip(edges, edges[1:], strict=False):
            shift, mask = U(low), U((1 << int(high - low)) - 1)
            values = (stored >> shift) & mask
            order = np.argsort(values, kind="stable")
            self.blocks.append((shift, mask, order, values[order]))

    def near(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``asked``, place in ``stored``) within the radius."""
        pairs = []
        for shift, mask, order, values in self.blocks:
            v = (asked >> shift) & mask
            low, high = np.searchsorted(values, v, "left"), np.searchsorted(values, v, "right")
            n = high - low
            who = np.repeat(np.arange(len(asked)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            pairs.append(who * len(self.stored) + order[at])
        both = np.unique(np.concatenate(pairs))
        who, what = both // len(self.stored), both % len(self.stored)
        close = np.bitwise_count(asked[who] ^ self.stored[what]) <= self.radius
        return who[close], what[close]


def similarity(a: list[bytes], b: list[bytes], width: int) -> float:
    """Weighted Jaccard similarity of the shingles of two word lists."""
    x, y = (Counter(zip(*(w[k:] for k in range(width)), strict=False)) for w in (a, b))
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


class Items:
    """A block of items, ready to be compared with texts."""

    def __init__(self, items: list[tuple[int, bytes]], settings: Settings):
        self.settings = settings
        self.ids, self.words = [], []
        for i, body in items:
            w = words_of(body)
            if w:
                self.ids.append(i)
                self.words.append(w)
        by_size: dict[int, list[int]] = {}
        for k, w in enumerate(self.words):
            by_size.setdefault(len(w), []).append(k)
        self.prints = np.zeros(len(self.words), U)
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for n, which in by_size.items():
            width = min(n, settings.shingle)
            for k in which:
                all_s = shingles(hashed(self.words[k]), width)
                self.prints[k] = fingerprints(all_s, n - width + 1)[0]
                flat = np.unique(all_s)
                found.setdefault(width, []).append((flat, np.full(len(flat), k)))
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.known = {}
        for width, parts in found.items():
            s, k = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(s, kind="stable")
            bits = max(16, int(len(s) * 16).bit_length())
            filled = np.zeros(1 << bits, bool)
            filled[(s >> U(64 - bits)).astype(np.int64)] = True
            self.known[width] = (s[order], k[order], bits, filled)

    def hits(self, s: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose shingle some items have, with each of those items."""
        known, owner, bits, filled = self.known[width]
        at = np.flatnonzero(filled[(s >> U(64 - bits)).astype(np.int64)])
        low, high = np.searchsorted(known, s[at], "left"), np.searchsorted(known, s[at], "right")
        n = high - low
        which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return np.repeat(at, n), owner[which]

    def compare(self, words: list[bytes], first_only: bool = False) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window for each item that a text holds."""
        best: dict[int, tuple[float, int]] = {}
        if not words:
            return []
        h = hashed(words)
        for width in self.known:
            s = shingles(h, width)
            if not len(s):
                continue
            at, owner = self.hits(s, width)
            size = np.minimum(self.size[owner], len(words))  # a shorter document is one window
            for n in np.unique(size).tolist():
                mine = size == n
                self._windows(words, s, at[mine], owner[mine], n, width, best)
                if first_only and best:
                    return [(0, 0, 0, 0.0)]
        return [(k, start, len(self.words[k]), sim) for k, (sim, start) in sorted(best.items())]

    def _windows(self, words: list[bytes], s: np.ndarray, at: np.ndarray, owner: np.ndarray, n: int, width: int, best: dict) -> None:
        """Compare windows of ``n`` words with the items of which they hold a shingle (``at`` a place, ``owner`` the item)."""
        last, step = len(words) - n, self.settings.windows_at_once
        low, high = np.clip(at - (n - width), 0, last), np.clip(at, 0, last)  # windows that hold the place
        items, owner = np.unique(owner, return_inverse=True)
        index = HammingIndex(self.prints[items], self.settings.radius)
        marks = np.zeros(last + 2, np.int64)  # windows that hold any, as a difference array
        np.add.at(marks, low, 1)
        np.add.at(marks, high + 1, -1)
        starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
        first = [np.sort(low[owner == k]) for k in range(len(items))]
        final = [np.sort(high[owner == k]) for k in range(len(items))]
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for i in range(0, len(run), step):
                a, b = int(run[i]), int(run[min(i + step, len(run)) - 1])
                who, what = index.near(fingerprints(s[a : b + n - width + 1], n - width + 1))
                for k in np.unique(what).tolist():
                    w = who[what == k] + a
                    # of an item's places more begin at or before the window than end before it: the window holds one
                    holds = np.searchsorted(first[k], w, "right") > np.searchsorted(final[k], w, "left")
                    self._verify(words, w[holds].tolist(), int(items[k]), n, width, best)

    def _verify(self, words: list[bytes], starts: list[int], k: int, n: int, width: int, best: dict) -> None:
        for start in starts:
            sim = similarity(words[start : start + n], self.words[k], width)
            if sim >= self.settings.similarity and (k not in best or sim > best[k][0]):
                best[k] = (sim, start)


class Block:
    """Items as they travel: raw texts, made ready once in each worker."""

    def __init__(self, items: list[tuple[int, bytes]], settings: Settings):
        self.items, self.settings, self.ready = items, settings, None

    def __getstate__(self) -> dict:
        return {"items": self.items, "settings": self.settings, "ready": None}

    def get(self) -> Items:
        if self.ready is None:
            self.ready = Items(self.items, self.settings)
        return self.ready


def blocks(items: DataFrame, settings: Settings = DEFAULT) -> Iterator[Block]:
    """Distinct items, in blocks of bounded size."""
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    flat = items.select(F.col("item_id").cast("long").alias("item_id"), body.alias("body")).distinct()
    total = flat.agg(F.sum(F.length("body") + 64).alias("n")).first()["n"] or 0
    parts = max(1, -(-int(total * 1.25) // settings.block_bytes))
    part = F.pmod(F.xxhash64("item_id", "body"), F.lit(parts))
    for i in range(parts):
        rows = flat.where(part == i).orderBy("item_id", "body").collect()  # block_bytes, give or take the hash's evenness
        yield Block([(r["item_id"], bytes(r["body"])) for r in rows], settings)


SCHEMA = "doc_id long, item_id long, first_word long, n_words long, similarity double"


def matches(df: DataFrame, items: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """A row for each document and item it holds, with its best window."""
    types = common.pa_schema(SCHEMA)
    rows = common.text_rows(df)
    out = None
    for block in blocks(items, settings):

        def run(batches: Iterator[pa.RecordBatch], block: Block = block) -> Iterator[pa.RecordBatch]:
            ready = block.get()
            for batch in batches:
                got = [(d, ready.ids[k], start, n, sim) for d, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for k, start, n, sim in ready.compare(words_of(body))]
                yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], t.type) for i, t in enumerate(types)], schema=types)

        part = rows.mapInArrow(run, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def clean(df: DataFrame, items: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    for block in blocks(items, settings):

        @F.arrow_udf("boolean")
        def holds(column, block=block):
            ready = block.get()
            return pa.array([bool(ready.compare(words_of(x), first_only=True)) for x in column.to_pylist()], pa.bool_())

        df = df.where(~holds(body))
    return df
