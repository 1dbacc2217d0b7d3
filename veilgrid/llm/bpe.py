"""Byte-level BPE encoding and decoding.

Two tiers. A minimal perfect hash over the vocabulary resolves a pre-token that is a token itself: one probe,
one comparison. A miss goes to the merge loop: the bytes form a linked list, a heap holds the mergeable
neighbours by rank, and the lowest rank (leftmost on ties) merges first. Entries made stale by a merge are
skipped as they come up, so a pre-token of n bytes takes O(n log n) however long it is.

Cases: a null or empty text has no tokens. Repeated rows each get a row. Texts are encoded whole. The
vocabulary is read on the driver (its size is fixed by the file) and travels with the task.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Remembered pre-tokens in a worker; a cache only: beyond it, the memory starts anew.
REMEMBERED = 600_000
#: Longer pre-tokens are not remembered.
REMEMBERED_CHARS = 64


#: A space with white space, a control character or a text's end beside it.
AROUND_SPACE = regex.compile(r"^ | $| [\s\x00-\x1f]|[\s\x00-\x1f] ").search


class PerfectHash:
    """A minimal perfect hash of byte strings to 0..n-1: hash, displace, and place lone keys in what is left."""

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        buckets: dict[int, list[bytes]] = {}
        for k in keys:
            buckets.setdefault(xxhash.xxh32_intdigest(k) % n, []).append(k)
        self.shift = [0] * n
        self.keys: list[bytes | None] = [None] * n
        for at, own in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:
                break
            seed = 1
            while True:
                slots = {xxhash.xxh32_intdigest(k, seed) % n for k in own}
                if len(slots) == len(own) and all(self.keys[s] is None for s in slots):
                    break
                seed += 1
            self.shift[at] = seed
            for k in own:
                self.keys[xxhash.xxh32_intdigest(k, seed) % n] = k
        free = (i for i, k in enumerate(self.keys) if k is None)
        for at, own in buckets.items():
            if len(own) == 1:
                slot = next(free)
                self.shift[at] = -slot - 1
                self.keys[slot] = own[0]

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 for a string that is no key."""
        shift = self.shift[xxhash.xxh32_intdigest(key) % self.n]
        slot = -shift - 1 if shift < 0 else xxhash.xxh32_intdigest(key, shift) % self.n
        return slot if self.keys[slot] == key else -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ids of a rank file: base64 and a number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(x): int(y) for x, y in (line.split() for line in f if line.strip())}


class Tokenizer:
    """Encodes and decodes by ranks; ``pattern`` splits texts into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.hash = PerfectHash(list(ranks))
        self.ids = [ranks.get(k, -1) for k in self.hash.keys]
        size = max(ranks.values(), default=-1) + 1
        self.bytes_of: list[bytes | None] = [None] * size  # by id, as ids are dense
        for k, v in ranks.items():
            self.bytes_of[v] = k
        self.text_of = [str(i) for i in range(size)]
        self.find = regex.compile(pattern).findall
        self.memory: dict[str, tuple[int, ...]] = {}
        self.units: dict[str, tuple[int, ...]] = {}
        self.remembered = REMEMBERED
        self.spaced = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+" in pattern

    def __reduce__(self):
        return Tokenizer, (self.ranks, self.pattern)

    def rank(self, piece: bytes) -> int:
        slot = self.hash.slot(piece)
        return -1 if slot < 0 else self.ids[slot]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a pre-token that is no token: a heap of pairs over a linked list of its parts."""
        n, ranks = len(piece), self.ranks
        after = list(range(1, n + 1))  # start of the next part; n ends the list
        before = list(range(-1, n - 1))
        rank = ranks.get
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            r, i, end = heappop(heap)
            middle = after[i]
            if middle >= n or middle < 0 or after[middle] != end:  # one of the two has changed meanwhile
                continue
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                if (r := rank(piece[i : after[end]])) is not None:
                    heappush(heap, (r, i, after[end]))
            if i and (r := rank(piece[before[i] : end])) is not None:
                heappush(heap, (r, before[i], end))
        out, i = [], 0
        while i < n:
            out.append(rank(piece[i : after[i]], -1))
            i = after[i]
        if -1 in out:
            raise ValueError("a byte has no token of its own in this vocabulary")
        return tuple(out)

    def piece(self, text: str) -> tuple[int, ...]:
        raw = text.encode()
        r = self.rank(raw)
        ids = (r,) if r >= 0 else self.merge(raw)
        if len(text) <= REMEMBERED_CHARS:
            if len(self.memory) >= self.remembered:
                self.memory.clear()
            self.memory[text] = ids
        return ids

    def unit(self, text: str) -> tuple[int, ...]:
        """Ids of a run that no pre-token leaves."""
        known, piece = self.memory.get, self.piece
        ids = tuple(i for x in self.find(text) for i in known(x) or piece(x))
        if len(text) <= REMEMBERED_CHARS:
            if len(self.units) >= self.remembered:
                self.units.clear()
            self.units[text] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; text that looks like a special token is ordinary text.

        Where the pattern gives a lone space to the word after it (``spaced``), pre-tokens never cross the place
        before such a space, so words are looked up with their space and only new ones are split by the pattern.
        """
        out: list[int] = []
        add = out.extend
        if self.spaced and text and not AROUND_SPACE(text):
            known, unit = self.units.get, self.unit
            first, *rest = text.split(" ")
            add(unit(first))
            for x in rest:
                x = " " + x
                add(known(x) or unit(x))
            return out
        known, piece = self.memory.get, self.piece
        for x in self.find(text):
            add(known(x) or piece(x))
        return out

    def forget(self) -> None:
        """Give back what is remembered, so that later work in this process has the memory."""
        self.memory.clear()
        self.units.clear()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


#: One tokenizer for each vocabulary in a worker, whatever the number of its tasks.
_WORKER: dict[str, Tokenizer] = {}


def tokenizer(key: str, ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Tokenizer(ranks, pattern)
    return _WORKER[key]


def _shared(df: DataFrame, path: str, pattern: str):
    """The vocabulary as a broadcast, and what names it."""
    ranks = read_ranks(path)
    return df.sparkSession.sparkContext.broadcast(ranks), hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()


def encode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and its ``ids``."""
    held, key = _shared(df, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(key, held.value, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([t.encode(x.decode("utf-8", "replace")) for x in batch.column(1).to_pylist()], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return common.text_rows(df).mapInArrow(run, "doc_id long, ids array<long>")


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the ``body`` its ``ids`` stand for, as bytes; null ids count as none."""
    held, key = _shared(df, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(key, held.value, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([t.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "body"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, body binary")


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digest(df: DataFrame, path: str, pattern: str, remembered: int = REMEMBERED) -> DataFrame:
    """Encode and decode each text and give the digests of both, so that no ids leave the worker.

    ``remembered``: pre-tokens that a worker remembers. With less than the default it also forgets them after each task,
    which leaves memory to other stages in the same workers.
    """
    held, key = _shared(df, path, pattern)
    types = common.pa_schema(SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(key, held.value, pattern)
        t.remembered = remembered
        text_of = t.text_of.__getitem__
        for batch in batches:
            counts, first, second = [], [], []
            for body in batch.column(1).to_pylist():
                ids = t.encode(body.decode("utf-8", "replace"))
                counts.append(len(ids))
                first.append(hashlib.sha256(",".join(map(text_of, ids)).encode()).hexdigest())
                second.append(hashlib.sha256(t.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], schema=types)
        if remembered < REMEMBERED:
            t.forget()

    return common.text_rows(df).mapInArrow(run, SCHEMA)


def token_lengths(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """The documents with all their columns and the ids of their texts, in ``token_ids``."""
    held, key = _shared(df, path, pattern)

    @F.arrow_udf("array<int>")
    def ids(column):
        t = tokenizer(key, held.value, pattern)
        return pa.array([t.encode(x.decode("utf-8", "replace")) for x in column.to_pylist()], pa.list_(pa.int32()))

    return df.withColumn("token_ids", ids(F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))))
