"""Substring dedup by prefix-partitioned suffix trees over words.

Suffixes that could repeat (their 13-word windows share an anchor with another document, see :mod:`anchors`) meet in
buckets. There variable-length prefixes split them: suffixes are parted by their first word, and wherever a part is
larger than ``memory`` suffixes, by one word more. Each part becomes a suffix tree in memory, held as its leaves in
order and the depths of the nodes between neighbours. Internal nodes at least 13 words deep are repeats; the least
document below a node decides for all leaves below it. A prefix of 13 words is such a node by itself and needs no tree.

Rows with equal ids do not remove each other's words. A null id counts as greater than all others. Null, empty and
short texts keep all their words.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .anchors import LAST, Method, Shape, U, apply, spread
from .decontaminate import mixed


def deep_nodes(x: np.ndarray, suffixes: np.ndarray, depth: int, memory: int) -> np.ndarray:
    """For each suffix the number of its node at ``depth`` words; suffixes with one number share their first words."""
    node = np.empty(len(suffixes), np.int64)
    todo, made = [(np.arange(len(suffixes)), 0)], 0
    while todo:
        at, shared = todo.pop()
        if shared == depth:  # all words of the prefix agree
            node[at] = made
            made += 1
        elif len(at) <= memory:
            s = suffixes[at]
            order = np.lexsort([x[s + k] for k in range(depth - 1, shared - 1, -1)])
            leaves = s[order]
            common = np.full(max(0, len(leaves) - 1), depth)  # words that neighbouring leaves share
            for k in range(depth - 1, shared - 1, -1):
                common[x[leaves[1:] + k] != x[leaves[:-1] + k]] = k
            number = np.concatenate([[0], np.cumsum(common < depth)]) + made
            node[at[order]] = number
            made = int(number[-1]) + 1
        else:
            word = x[suffixes[at] + shared]
            order = np.argsort(word, kind="stable")
            at, word = at[order], word[order]
            edges = [0, *(np.flatnonzero(word[1:] != word[:-1]) + 1).tolist(), len(at)]
            begin = 0
            for a, z in zip(edges, edges[1:], strict=False):
                if z - a > memory:
                    if a > begin:
                        todo.append((at[begin:a], shared))
                    todo.append((at[a:z], shared + 1))
                    begin = z
                elif z - begin > memory:
                    todo.append((at[begin:a], shared))
                    begin = a
            if begin < len(at):
                todo.append((at[begin:], shared))
    return node


class Words(Method):
    """Windows of words that also start in a smaller document."""

    columns = "n_words long, n_removed long, kept_sha256 string"
    ordered = True
    unit_type = U

    def __init__(self, length: int = 13, memory: int = 200_000, **shape: int):
        self.shape = Shape(length=length, gram=min(5, length), **{"piece": 1 << 17, **shape})
        self.memory = memory

    def units(self, body: bytes) -> np.ndarray:
        words = body.split()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U, count=len(words))

    def grams(self, x: np.ndarray) -> np.ndarray:
        k = self.shape.gram
        padded = np.concatenate([x, np.zeros(k - 1, U)])
        h = np.zeros(len(x), U)
        for j in range(k):
            h = h * U(0x9E3779B97F4A7C15) + padded[j : j + len(x)]
        return mixed(h)

    def several(self, first: np.ndarray, which: np.ndarray, row: np.ndarray, doc: np.ndarray) -> np.ndarray:
        low, high = np.full(len(first), LAST), np.full(len(first), -LAST)
        np.minimum.at(low, which, doc[row])
        np.maximum.at(high, which, doc[row])
        return low != high

    def solve(self, parts: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
        key, doc, count = (np.concatenate([p[n] for p in parts]) for n in ("key", "doc", "count"))
        count = count.astype(np.int64)
        x = np.concatenate([p["units"] for p in parts])
        long = count + self.shape.length - 1
        begin = np.cumsum(long) - long
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        least = np.full(len(first), LAST)
        np.minimum.at(least, which, doc)
        n = count[first]
        node = deep_nodes(x, spread(begin[first], n), self.shape.length, self.memory)
        least_of = np.full(int(node.max(initial=-1)) + 1, LAST)
        np.minimum.at(least_of, node, np.repeat(least, n))
        window = least_of[node]  # by window of the distinct segments
        at = np.cumsum(n) - n
        flags = window[spread(at[which], count)] < np.repeat(doc, count)
        return np.split(flags, np.cumsum([int(p["count"].sum()) for p in parts])[:-1])

    def result(self, doc: list, bodies: list[bytes], units: list[np.ndarray], removed: list[np.ndarray | None]) -> dict[str, list]:
        gone, sha = [], []
        for body, mask in zip(bodies, removed, strict=True):
            words = body.split()
            gone.append(0 if mask is None else int(mask.sum()))
            sha.append(hashlib.sha256(b" ".join(words if mask is None else compress(words, (~mask).tolist()))).hexdigest())
        return {"n_words": [len(x) for x in units], "n_removed": gone, "kept_sha256": sha}


def dedup(df: DataFrame, **settings: int) -> DataFrame:
    """For each document its words, the words removed and a digest of those kept."""
    return apply(df, Words(**settings))
