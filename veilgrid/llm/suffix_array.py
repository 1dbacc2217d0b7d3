"""Suffix-array dedup by the difference-cover algorithm, over bytes.

Texts that could repeat (their 200-byte windows share an anchor with another place, see :mod:`anchors`) meet in
buckets. A bucket sorts the suffixes of its distinct segments with the difference cover {1, 2} modulo 3: triples at
sampled places are sorted and named; where names tie, the string of names is sorted the same way; the remaining
suffixes follow from their first byte and the next sampled rank, and are merged. Neighbours in the order that agree
in 200 bytes are repeats. As no more than 200 bytes matter, naming stops once names stand for that many.

Segments that are equal as a whole are repeats without sorting, and one that has its anchor to itself can equal no
other, so only anchors with several distinct segments are sorted. An anchor whose distinct segments fill more than
a sort holds (2 MB; a passage in thousands of different surroundings) is settled by hashes of its windows and
a comparison of their bytes.

Rows alike in id and text are two places and remove each other's bytes. Null, empty and short texts keep all bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .anchors import Method, Shape, U, apply, spread
from .decontaminate import mixed


def suffix_order(t: np.ndarray, enough: int, covered: int = 1) -> np.ndarray:
    """Places of ``t`` (symbols from 1, under 2^21) by their suffixes, as far as ``enough`` symbols of the text tell.

    ``covered``: symbols of the text that one symbol of ``t`` stands for.
    """
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    p = np.concatenate([t, [0, 0, 0, 0]]).astype(np.int64)
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triple = (p[sample] << 42) | (p[sample + 1] << 21) | p[sample + 2]
    values, name = np.unique(triple, return_inverse=True)
    rank = np.zeros(n + 4, np.int64)
    if len(values) == len(sample) or covered * 3 >= enough:
        order = np.argsort(name, kind="stable")
    else:
        order = suffix_order(name + 1, enough, covered * 3)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    zero = np.arange(0, n, 3)
    by_next = p[zero] << 32 | rank[zero + 1]
    zero = zero[np.argsort(by_next, kind="stable")]
    # how many sampled suffixes stand before each of the others: by one symbol and a rank, or two and a rank
    less = np.searchsorted(np.sort(p[one] << 32 | rank[one + 1]), p[zero] << 32 | rank[zero + 1])
    less += np.searchsorted(np.sort(((p[two] << 21 | p[two + 1]) << 21) | rank[two + 2]), ((p[zero] << 21 | p[zero + 1]) << 21) | rank[zero + 2])
    sampled = sample[order]
    merged = np.concatenate([zero, sampled])[np.argsort(np.concatenate([less * 2, np.arange(len(sampled)) * 2 + 1]), kind="stable")]
    return merged[merged < n]


def repeated(x: np.ndarray, starts: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """For each window of the segments (``counts`` windows from ``starts``) whether its bytes start elsewhere too."""
    long = counts + length - 1
    text = np.ones(int((long + 1).sum()), np.int64)  # 1 parts the segments
    begin = np.cumsum(long + 1) - (long + 1)
    inside = spread(begin, long)
    text[inside] = x[spread(starts, long)].astype(np.int64) + 2
    window = np.full(len(text), -1, np.int64)
    places = spread(begin, counts)
    window[places] = np.arange(len(places))
    order = suffix_order(text, length)
    order = order[window[order] >= 0]
    raw = np.zeros(len(text) + 8, np.uint8)
    raw[: len(text)] = text.clip(0, 255)  # two byte values may share a code here; the last look is at the text itself
    eights = np.ndarray((len(text),), dtype="<u8", buffer=raw.data, strides=(1,))
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 and length >= 8 else [])]:
        same = same[eights[a[same] + k] == eights[b[same] + k]]
    for k in range(length if length < 8 else 0):
        same = same[text[a[same] + k] == text[b[same] + k]]
    high = np.flatnonzero(text >= 255)
    if len(high) and len(same):  # only bytes over 252 lose their identity above; texts in UTF-8 have none
        rows = text[a[same][:, None] + np.arange(length)] == text[b[same][:, None] + np.arange(length)]
        same = same[rows.all(axis=1)]
    flags = np.zeros(len(places), bool)
    flags[window[a[same]]] = True
    flags[window[b[same]]] = True
    return flags


class Bytes(Method):
    """Windows of bytes that also start anywhere else."""

    columns = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    ordered = False
    unit_type = np.uint8

    def __init__(self, length: int = 200, memory: int = 1 << 19, **shape: int):
        gram = 32 if length >= 64 else 8
        self.shape = Shape(length=length, gram=gram, **{"one_in": 16 if length >= 128 else 1, **shape})
        self.memory = memory  # bytes sorted at once; symbols must stay under 2^21

    def units(self, body: bytes) -> np.ndarray:
        return np.frombuffer(body, np.uint8)

    def grams(self, x: np.ndarray) -> np.ndarray:
        padded = np.concatenate([x, np.zeros(self.shape.gram + 8, np.uint8)])
        h = np.zeros(len(x), U)
        for j, factor in zip(range(0, self.shape.gram, 8), (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93), strict=False):
            h += np.ndarray((len(x),), dtype="<u8", buffer=padded.data, offset=j, strides=(1,)) * U(factor)
            h ^= h >> U(29)
        return mixed(h)

    def several(self, first: np.ndarray, which: np.ndarray, row: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return np.bincount(which, minlength=len(first)) > 1

    def solve(self, parts: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
        key, anchor, count = (np.concatenate([p[n] for p in parts]) for n in ("key", "anchor", "count"))
        count = count.astype(np.int64)
        x = np.concatenate([p["units"] for p in parts])
        long = count + self.shape.length - 1
        begin = np.cumsum(long) - long
        _, first, which, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        # distinct segments by anchor; those alone at theirs are settled
        _, group, alike = np.unique(anchor[first], return_inverse=True, return_counts=True)
        some = np.flatnonzero(alike[group] > 1)
        some = some[np.argsort(group[some], kind="stable")]
        n = count[first]
        at = np.cumsum(n) - n
        window = np.repeat(times > 1, n)
        if len(some):
            size = np.cumsum(long[first[some]] + 1)
            last = np.flatnonzero(np.diff(group[some], append=-1))  # anchors are not split
            edges, begun = [0], 0
            for i, j in zip(last.tolist(), [*last[1:].tolist(), -1], strict=True):
                if j < 0 or size[j] - begun > self.memory:
                    edges.append(i + 1)
                    begun = int(size[i])
            for a, z in zip(edges, edges[1:], strict=False):
                self._sort(x, begin[first], n, at, some[a:z], window)
        flags = window[spread(at[which], count)]
        return np.split(flags, np.cumsum([int(p["count"].sum()) for p in parts])[:-1])

    def _sort(self, x: np.ndarray, begin: np.ndarray, n: np.ndarray, at: np.ndarray, chosen: np.ndarray, window: np.ndarray) -> None:
        """Sort some segments; one anchor with more text than a sort holds is settled by its windows' hashes and bytes."""
        if int((n[chosen] + self.shape.length).sum()) < 1 << 21:
            window[spread(at[chosen], n[chosen])] |= repeated(x, begin[chosen], n[chosen], self.shape.length)
            return
        starts, places = spread(begin[chosen], n[chosen]), spread(at[chosen], n[chosen])
        self._equal(x, starts, places, self._window_hash(x, starts), window)

    def _window_hash(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        h = np.zeros(len(starts), U)
        for k in range(self.shape.length):
            h = h * U(0x9E3779B97F4A7C15) + x[starts + k].astype(U)
        return mixed(h)

    def _equal(self, x: np.ndarray, starts: np.ndarray, places: np.ndarray, h: np.ndarray, window: np.ndarray) -> None:
        order = np.argsort(h, kind="stable")
        a, b = order[:-1], order[1:]
        same = h[a] == h[b]
        for k in range(self.shape.length):
            same &= x[starts[a] + k] == x[starts[b] + k]
        window[places[a[same]]] = True
        window[places[b[same]]] = True

    def result(self, doc: list, bodies: list[bytes], units: list[np.ndarray], removed: list[np.ndarray | None]) -> dict[str, list]:
        gone, spans, sha = [], [], []
        for body, x, mask in zip(bodies, units, removed, strict=True):
            gone.append(0 if mask is None else int(mask.sum()))
            spans.append(0 if mask is None else int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1)))
            sha.append(hashlib.sha256(body if mask is None else x[~mask].tobytes()).hexdigest())
        return {"n_bytes": [len(b) for b in bodies], "n_removed": gone, "n_spans": spans, "kept_sha256": sha}


def dedup(df: DataFrame, **settings: int) -> DataFrame:
    """For each document its bytes, the bytes removed, the runs they form and a digest of what is left."""
    return apply(df, Bytes(**settings))
