"""Quality classifier: Bradley-Terry ranking learned from preference pairs, thresholded by a score quantile.

A document with label 1 is preferred to one with label 0. The strength of a document is linear in features
of its text, and the model minimises the logistic loss of feature differences over all pairs of a good and a bad
row. Strengths have no zero of their own, so the threshold is the quantile of the training strengths that has the
share of label 0 below it; the score maps it to ``threshold`` with a logistic curve.

All labelled rows outside the held-out fold are learned from, and all of their pairs. The loss of a pair depends on two
strengths only, so sums over the rows at each strength stand for the pairs: a pass over the rows deals each to the two
nearest of a grid of strengths (:data:`STEP`), and the pairs of grid points give slope and loss. That is an
interpolation, off by some 1e-5 of a pair's weight, not a sample. The quantiles are exact. Every document is scored, whole.
Null and empty texts have all features zero and are scored like any other. Labels, language, source and ids are no features.
Without a labelled row of either kind all strengths are zero and every score is ``threshold``.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .compression import SYMBOLS, dup_lines, repeat_words

FEATURES = ("log_words", "symbols", "upper", "marks", "doubled", "digits", "distinct", "repeats", "dup_lines", "word_chars", "log_long_word", "ratio", "line_chars", "top_word", "ends", "non_ascii")
UPPER, DIGITS, MARKS, ENDS = bytes(range(65, 91)), b"0123456789", b"!?", b".,;:"


def features(body: bytes, compressor: zstandard.ZstdCompressor) -> list[float]:
    """Numbers that describe a text, all of a like size."""
    words = body.split()
    n, size = len(words), len(body)
    if not n:
        return [0.0] * len(FEATURES)
    share = lambda chars: (size - len(body.translate(None, chars))) / size
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    letters = size - len(body.translate(None, bytes(range(97, 123))))
    upper = size - len(body.translate(None, UPPER))
    lines = body.count(b"\n") + 1
    return [
        math.log1p(n) / 10,
        share(SYMBOLS) * 10,
        upper / max(1, upper + letters),
        share(MARKS) * 10,
        (body.count(b"!!") + body.count(b"??") + body.count(b"**") + body.count(b"##") + body.count(b"%%") + body.count(b"$$") + body.count(b"&&")) / n,
        share(DIGITS) * 10,
        len(counts) / n,
        repeat_words(words) / n,
        dup_lines(body) / lines,
        sum(map(len, words)) / n / 10,
        math.log1p(max(map(len, counts))) / 5,
        min(1.5, len(compressor.compress(body)) / size),
        math.log1p(size / lines) / 10,
        max(counts.values()) / n,
        share(ENDS) * 10,
        (size - len(body.decode("utf-8", "replace"))) / size,
    ]


@dataclass(frozen=True)
class Settings:
    """``pairs``: preference pairs drawn at random, of rows collected on the driver, for trials on small tables; None for all pairs."""

    pairs: int | None = None
    threshold: float = 0.3
    decay: float = 1e-4
    rounds: int = 30
    seed: int = 17


DEFAULT = Settings()


@dataclass(frozen=True)
class Model:
    """A strength for each document, and where the threshold lies."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    slope: float
    threshold: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        return expand(x, np.array(self.mean), np.array(self.scale)) @ np.array(self.weights)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (self.strengths(x) - self.cut) * self.slope + math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, and their squares so that both ends can count against a text."""
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([z, z * z / 6])


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = DEFAULT) -> Model:
    """The model of rows in memory, by all pairs or by ``settings.pairs`` of them."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if settings.pairs is None:
        return learn(lambda part, merge: part(x, y), settings)
    if not len(good) or not len(bad):
        return neutral(settings)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = expand(x, mean, scale)
    rng = np.random.default_rng(settings.seed)
    d = z[rng.choice(good, settings.pairs)] - z[rng.choice(bad, settings.pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(settings.rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))
        slope = d.T @ (p - 1) / len(d) + settings.decay * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + settings.decay * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w = w - move
        if np.abs(move).max() < 1e-6:
            break
    s = z @ w
    cut = float(np.quantile(s, len(bad) / len(y)))
    return finished(mean, scale, w, cut, float(np.median(s[good]) - np.median(s[bad])), settings)


def neutral(settings: Settings) -> Model:
    """All strengths zero."""
    width = len(FEATURES)
    return Model((0.0,) * width, (1.0,) * width, (0.0,) * 2 * width, 0.0, 1.0, settings.threshold)


def finished(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, cut: float, spread: float, settings: Settings) -> Model:
    return Model(tuple(map(float, mean)), tuple(map(float, scale)), tuple(map(float, w)), cut, 8 / spread if spread > 0 else 1.0, settings.threshold)


#: Sums of rows: what ``part`` makes of features and labels, put together by ``merge``.
Pass = Callable[[Callable[[np.ndarray, np.ndarray], dict], Callable[[dict, dict], dict]], dict]

#: Grid of strengths for slope and loss; cells of strengths for the curvature, which only says how far to move.
STEP, CELL = 1 / 64, 1 / 2
#: Cells a range is narrowed by at once, values that are listed, rows and grid points taken at once.
CELLS, LISTED, ROWS, POINTS = 4096, 50_000, 50_000, 256


def added(a: dict, b: dict) -> dict:
    for k, v in b.items():
        a[k] = a[k] + v if k in a else v
    return a


def listed(a: dict, b: dict) -> dict:
    return {k: np.concatenate([a[k], b[k]]) for k in a}


def dealt(x: np.ndarray, y: np.ndarray, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> dict:
    """By label: counts and feature sums at the grid points (each row shared by the two next to it), and second moments by cell."""
    out: dict = {}
    z = expand(x, mean, scale)
    z = np.hstack([np.ones((len(z), 1)), z])
    s = z[:, 1:] @ w
    for label in (0, 1):
        one, at = z[y == label], s[y == label] / STEP
        left = np.floor(at)
        for points, share in ((left, 1 - (at - left)), (left + 1, at - left)):
            keys, where = np.unique(points.astype(np.int64), return_inverse=True)
            sums = np.stack([np.bincount(where, share * c, len(keys)) for c in one.T], 1)
            added(out, {(label, int(k)): v for k, v in zip(keys, sums, strict=True)})
        cell = np.rint(s[y == label] / CELL).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        keys, first = np.unique(cell[order], return_index=True)
        for k, rows in zip(keys, np.split(one[order], first[1:]), strict=True):
            added(out, {(label, int(k), "cell"): rows.T @ rows})
    return out


def _grid(sums: dict, label: int, cells: bool) -> tuple[np.ndarray, np.ndarray]:
    keys = sorted(k for k in sums if k[0] == label and (len(k) == 3) == cells)
    return np.array([k[1] for k in keys]) * (CELL if cells else STEP), np.array([sums[k] for k in keys])


def slope_of(sums: dict, w: np.ndarray, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, slope and curvature of the mean pair; the curvature is that of pairs whose strengths lie at their cells' middles, so never negative."""
    (gs, g), (bs, b) = _grid(sums, 1, False), _grid(sums, 0, False)
    n = g[:, 0].sum() * b[:, 0].sum()
    loss, slope = 0.0, np.zeros(len(w))
    for i in range(0, len(gs), POINTS):
        t = gs[i : i + POINTS, None] - bs
        part = g[i : i + POINTS]
        loss += part[:, 0] @ np.logaddexp(0, -t) @ b[:, 0]
        p = 1 / (1 + np.exp(np.clip(t, -500, 500)))
        slope -= part[:, 1:].T @ (p @ b[:, 0]) - b[:, 1:].T @ (part[:, 0] @ p)
    (gs, g), (bs, b) = _grid(sums, 1, True), _grid(sums, 0, True)
    p = 1 / (1 + np.exp(np.clip(gs[:, None] - bs, -500, 500)))
    p = p * (1 - p)
    cross = g[:, 0, 1:].T @ p @ b[:, 0, 1:]
    curve = np.tensordot(p @ b[:, 0, 0], g[:, 1:, 1:], 1) + np.tensordot(g[:, 0, 0] @ p, b[:, 1:, 1:], 1) - cross - cross.T
    return loss / n + decay * w @ w / 2, slope / n + decay * w, curve / n + decay * np.eye(len(w))


def ranked(over: Pass, strength: Callable[[np.ndarray], np.ndarray], bound: float, wanted: list[tuple[int | None, int]]) -> list[float]:
    """The strengths at some ranks (from 0) among the rows of a label, or of all: ranges are narrowed until what is left can be listed."""
    todo = {i: (label, -bound, bound, rank, None) for i, (label, rank) in enumerate(wanted)}
    done: dict[int, float] = {}

    def inside(s: np.ndarray, y: np.ndarray, label: int | None, low: float, high: float) -> np.ndarray:
        return s[(s >= low) & (s <= high) & (True if label is None else y == label)]

    while todo:
        long = {i: (label, low, high, np.linspace(low, high, CELLS + 1)) for i, (label, low, high, _, n) in todo.items() if n is None or n > LISTED}
        short = {i: t[:3] for i, t in todo.items() if i not in long}

        def counts(x: np.ndarray, y: np.ndarray, long: dict = long) -> dict:
            s = strength(x)
            return {i: np.bincount(np.clip(np.searchsorted(edges, inside(s, y, label, low, high), "right") - 1, 0, CELLS - 1), minlength=CELLS) for i, (label, low, high, edges) in long.items()}

        def values(x: np.ndarray, y: np.ndarray, short: dict = short) -> dict:
            s = strength(x)
            return {i: inside(s, y, *t) for i, t in short.items()}

        if short:
            for i, v in over(values, listed).items():
                done[i] = float(np.sort(v)[todo.pop(i)[3]])
        if long:
            for i, n in over(counts, added).items():
                label, _, high, edges = long[i]
                below = np.cumsum(n)
                c = int(np.searchsorted(below, todo[i][3], "right"))
                low, high = float(edges[c]), high if c == CELLS - 1 else float(np.nextafter(edges[c + 1], -np.inf))
                if low >= high:
                    done[i] = low
                    del todo[i]
                else:
                    todo[i] = (label, low, high, todo[i][3] - int(below[c] - n[c]), int(n[c]))
    return [done[i] for i in range(len(wanted))]


def learn(over: Pass, settings: Settings = DEFAULT) -> Model:
    """Newton's method on the pairwise logistic loss over all pairs, a pass over the rows for each step."""
    first = over(lambda x, y: {"n": np.array([(y == 0).sum(), (y == 1).sum()]), "x": x.sum(0)}, added)
    if not first or not first["n"].all():
        return neutral(settings)
    n0, n1 = map(int, first["n"])
    mean = first["x"] / (n0 + n1)
    scale = np.maximum(np.sqrt(over(lambda x, y: {"v": ((x - mean) ** 2).sum(0)}, added)["v"] / (n0 + n1)), 1e-3)
    at = lambda w: slope_of(over(lambda x, y: dealt(x, y, mean, scale, w), added), w, settings.decay)
    w = np.zeros(2 * len(FEATURES))
    loss, slope, curve = at(w)
    for _ in range(settings.rounds):
        move = np.linalg.solve(curve, slope)
        if np.abs(move).max() < 1e-5:
            break
        now = at(w - move)
        while now[0] > loss + 1e-12 and np.abs(move).max() >= 1e-5:
            move = move / 2
            now = at(w - move)
        w = w - move
        loss, slope, curve = now
    wanted, shares = [], [(None, n0 + n1, n0 / (n0 + n1)), (1, n1, 0.5), (0, n0, 0.5)]
    for label, n, q in shares:
        k = math.floor(q * (n - 1))
        wanted += [(label, k), (label, min(k + 1, n - 1))]
    bound = float(6 * np.abs(w).sum()) + 1.0
    found = ranked(over, lambda x: expand(x, mean, scale) @ w, bound, wanted)
    cut, good, bad = (a + (b - a) * (q * (n - 1) % 1) for (_, n, q), a, b in zip(shares, found[::2], found[1::2], strict=True))
    return finished(mean, scale, w, cut, good - bad, settings)


def passes(rows: DataFrame) -> Pass:
    """Passes over a table of ``label, x``: a few thousand sums of each partition come to the driver, never rows."""

    def over(part: Callable, merge: Callable) -> dict:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, xs, ys, n = None, [], [], 0

            def flush(total: dict | None) -> dict:
                got = part(np.concatenate(xs), np.concatenate(ys))
                return got if total is None else merge(total, got)

            for batch in batches:
                xs.append(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)))
                ys.append(batch.column(0).to_numpy(zero_copy_only=False))
                n += batch.num_rows
                if n >= ROWS:
                    total, xs, ys, n = flush(total), [], [], 0
            if n:
                total = flush(total)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["sums"])

        out: dict | None = None
        for row in rows.mapInArrow(run, "sums binary").collect():  # in the order of partitions
            got = pickle.loads(row.sums)
            out = got if out is None else merge(out, got)
        return out or {}

    return over


def held_out(id_col: Column) -> Column:
    """Whether the row is in the fold that is never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def _measured(rows: DataFrame) -> DataFrame:
    """``doc_id`` and the features of ``body``, as one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            x = [features(b, compressor) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return rows.mapInArrow(run, "doc_id long, x array<double>")


def measured(df: DataFrame) -> DataFrame:
    """``doc_id`` and features ``x`` of each document, stored: 130 bytes a row, read again by every pass."""
    return common.stored(_measured(common.text_rows(df)), "quality-features")


def train(df: DataFrame, labels: DataFrame, label_col: str = "quality", settings: Settings = DEFAULT) -> Model:
    """Fit on all labelled rows outside the held-out fold."""
    m = measured(df)
    model = train_measured(m, labels, label_col, settings)
    common.drop(m)
    return model


#: Rows of a partition in a pass, and partitions at most: their sums come to the driver together.
PART_ROWS, MAX_PARTS = 20_000, 16


def train_measured(m: DataFrame, labels: DataFrame, label_col: str = "quality", settings: Settings = DEFAULT) -> Model:
    """:func:`train` on features that are worked out."""
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label_col).cast("long").alias("label"))
    )
    rows = common.stored(m.join(chosen, "doc_id").sortWithinPartitions("doc_id", F.hash("x")).select("label", "x"), "quality-rows")
    if settings.pairs is not None:
        got = rows.toPandas()
        model = fit(np.array(got["x"].tolist(), dtype=float).reshape(-1, len(FEATURES)), got["label"].to_numpy(), settings)
    else:
        model = learn(passes(rows.coalesce(min(MAX_PARTS, 1 + rows.count() // PART_ROWS))), settings)
    common.drop(rows)
    return model


SCHEMA = "doc_id long, score double"


def score(df: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each document."""
    return score_measured(_measured(common.text_rows(df)), model)


def score_measured(m: DataFrame, model: Model) -> DataFrame:
    """:func:`score` of features that are worked out."""
    types = common.pa_schema(SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x), pa.float64())], schema=types)

    rows = m.mapInArrow(run, SCHEMA)
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= model.threshold).cast("int").alias("predicted"))


def rank(df: DataFrame, labels: DataFrame, label_col: str = "quality", settings: Settings = DEFAULT) -> DataFrame:
    """:func:`score` by the model of :func:`train`, with the features of each text worked out once."""
    m = measured(df)
    return score_measured(m, train_measured(m, labels, label_col, settings))
