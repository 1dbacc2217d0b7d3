"""Near-duplicate documents by a chosen-path similarity join.

A document's set has its distinct five-word shingles (A-Z folded; the whole sequence where it has fewer words). Sets
with a Jaccard similarity of at least 0.75 are linked, and documents reachable by links form a component.

Equal sets are one class from the start. Classes then pass down independent trees: in a node all classes
are told apart by the same minwise token or tokens, picked by the node's own hash, and those with equal tokens
go on to the same child. Nodes of up to ``limit`` classes are compared exhaustively on full sets; larger ones
branch further, by three tokens a step, to as many children a class as ``children`` has for the step. At the
root a linked pair meets in one tree with probability 0.75 or more, so ``trees`` = 14 leaves 4e-9 of pairs apart
where nodes are small. A child keeps a pair with the third power of 0.75 or more, so 2.37 children a class would just
keep the pairs that meet expected; :func:`lost` gives the share lost after each step, by the tokens there are.

Links matter, not pairs. First every class is compared with the centre of its node in a few trees: the class that agrees
most with the node's most frequent tokens, which among copies of one text is the text itself. Classes
that this joins need no more comparing with each other, so a node whose classes are all joined is done and thousands of
copies cost one comparison each. Elsewhere 64 minwise tokens rule out pairs that agree in fewer than 28 (at 0.75, one
in 1e7 does); what is left meets with its texts, all intersections of a node are counted by one matrix product, and
only links that join something are given out. Nodes that stay larger than ``limit`` after ``steps`` are compared
block by block, so nothing is capped.

A set's class has 128 bits: 64 name it, and where two sets share these, the others part them. Rows are told apart by id and
128 bits of id and text.

Cases: null and empty texts have an empty set, link with nothing and are their own component. Very long texts are
read whole; a set grows with its text. Repeated rows are equal sets. A null id takes the component's least id, if any has one; of a
component without any id the row with the least key stays. An empty table gives an empty one. Of rows alike in id and
text but not in other columns, :func:`dedup` keeps the one with the least hash of these. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .decontaminate import mixed, shingles

U = np.uint64


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 75
    trees: int = 14
    star_trees: int = 3
    star_tokens: int = 16
    tokens: int = 64
    agree: int = 28
    limit: int = 4096
    steps: int = 5
    children: tuple[int, ...] = (12, 5, 4, 3, 3)
    seed: int = 1


DEFAULT = Settings()


def shingle_set(body: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = body.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U, count=n)
    k = min(n, width)
    return np.unique(shingles(h, k) ^ U(k))


def minwise(s: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least hash of a set under each of several hash functions."""
    out = np.full(len(factors), (1 << 64) - 1, U)
    for i in range(0, len(s), 4096):
        x = s[i : i + 4096, None] * factors[None, :]
        x ^= x >> U(32)
        x *= U(0xD6E8FEB86659FD93)
        out = np.minimum(out, x.min(axis=0))
    return out ^ (out >> U(31))


def factors(settings: Settings) -> np.ndarray:
    rng = np.random.default_rng(settings.seed)
    return rng.integers(0, 1 << 63, settings.tokens, dtype=np.int64).astype(U) * U(2) + U(1)


SKETCH = "doc_id long, r1 long, r2 long, n_shingles long, cid long, check long, roots array<long>, sig array<short>"


def sketches(df: DataFrame, settings: Settings) -> DataFrame:
    """Ids, row keys, set sizes, the class of each set, its minwise tokens at the roots and 16 bits of all its tokens; empty sets have no class."""
    f = factors(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cid, check, roots, sig = [], [], [], [], []
            for body in batch.column(3).to_pylist():
                s = shingle_set(body, settings.shingle)
                n.append(len(s))
                first, second = class_of(s)
                cid.append(first)
                check.append(second)
                tokens = minwise(s, f) if len(s) else None
                roots.append(None if tokens is None else tokens[: settings.trees].view(np.int64))
                sig.append(None if tokens is None else tokens.astype(np.uint16).view(np.int16))
            made = [pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(check, pa.int64()), pa.array(roots, pa.list_(pa.int64())), pa.array(sig, pa.list_(pa.int16()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=[x.split()[0] for x in SKETCH.split(", ")])

    return _bodies(df).mapInArrow(run, SKETCH)


def class_of(s: np.ndarray) -> tuple[int | None, int | None]:
    """A number for a set, and a second one."""
    if not len(s):
        return None, None
    h = xxhash.xxh3_128_intdigest(s.tobytes())
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def _classes(docs: DataFrame) -> DataFrame:
    """A row for each class: its least document, its rows' least key, and whether sets that differ share it."""
    whole = docs.where("cid is not null").groupBy("cid")
    return whole.agg(F.min("doc_id").alias("rep"), F.min(F.struct("r1", "r2")).alias("row"), F.first("roots").alias("roots"), F.first("sig").alias("sig"), (F.min("check") != F.max("check")).alias("clash"))


def parted(docs: DataFrame, clash: DataFrame) -> DataFrame:
    """Sketches in which the sets of some classes get a class each, made of both their numbers."""
    marked = docs.join(clash.select("cid", F.lit(True).alias("both")), "cid", "left")
    return marked.withColumn("cid", F.when(F.col("both"), F.xxhash64("cid", "check")).otherwise(F.col("cid"))).select(*docs.columns)


def _bodies(df: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    r1, r2 = common.row_key("doc_id", "text")
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), r1.alias("r1"), r2.alias("r2"), body.alias("body"))


def class_texts(df: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """One text for each wanted class (``cid``, ``row`` of a document that has it)."""
    rows = wanted.select("cid", "row.r1", "row.r2").join(_bodies(df).select("r1", "r2", "body"), ["r1", "r2"]).select("cid", "body")
    return rows.dropDuplicates(["cid"])


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""

    def check(first: pa.Array, second: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(first.to_pylist(), second.to_pylist(), strict=True):
            out.append(similar(shingle_set(x, settings.shingle), shingle_set(y, settings.shingle), settings.percent))
        return pa.array(out, pa.bool_())

    left = texts.select(F.col("cid").alias("a"), F.col("body").alias("x"))
    right = texts.select(F.col("cid").alias("b"), F.col("body").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(F.arrow_udf(check, "boolean")("x", "y")).select("a", "b")


def print_of(edges: DataFrame) -> tuple:
    """A count and a digest that tell whether two sets of edges are equal."""
    return tuple(edges.selectExpr("count(*)", "bit_xor(xxhash64(a, b))", "sum(cast(hash(a, b) as bigint))").first())


def contracted(edges: DataFrame, chunk: int = 200_000) -> DataFrame:
    """Edges (``a``, ``b``) with the same components and fewer of them: each chunk of a task's edges becomes stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def stars() -> pa.RecordBatch:
            flat = [(x, r) for x in root if (r := find(x)) != x]
            root.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in flat], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                root.setdefault(x, x)
                root.setdefault(y, y)
                x, y = find(x), find(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
            if len(root) >= chunk:
                yield stars()
        if root:
            yield stars()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, settle: bool = True, chunk: int = 200_000) -> DataFrame:
    """``cid`` and its component's least ``cid``, for all ends of the edges: large and small stars in turn, until nothing changes.

    Without ``settle`` one round is enough: equal labels are then connected, though not all that are connected have one.
    """
    e = common.stored(contracted(edges, chunk), "edges")
    seen = print_of(e) if settle else None
    while True:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(down.select("a", F.col("m").alias("b"))).distinct()
        before, e = e, common.stored(small, "edges")
        common.drop(before)
        if not settle:
            break
        last, seen = seen, print_of(e)
        if last == seen:
            break
    own = e.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("cid"), "label")
    return own.union(e.select(F.col("b").alias("cid"), F.col("b").alias("label")).join(own, "cid", "left_anti").distinct())


def _stars(rows: DataFrame, settings: Settings) -> DataFrame:
    """Pairs of each class and the centre of its node."""
    at = range(0, settings.tokens, max(1, settings.tokens // settings.star_tokens))
    usual = rows.groupBy("node").agg(F.array(*(F.mode(F.get("sig", F.lit(i)), True) for i in at)).alias("usual"))
    agree = sum(((F.get("sig", F.lit(i)) == F.get("usual", F.lit(k))).cast("int") for k, i in enumerate(at)), F.lit(0))
    scored = rows.join(usual, "node").select("node", "cid", agree.alias("agree"))
    centre = scored.groupBy("node").agg(F.max_by("cid", F.struct("agree", "cid")).alias("b"))
    return rows.select("node", F.col("cid").alias("a")).join(centre, "node").where("a <> b").select("a", "b").distinct()


def _told(rows: DataFrame) -> DataFrame:
    """Rows of nodes whose classes are not all joined, with the node's size ``n``."""
    nodes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("node", "n")
    return rows.join(nodes, "node")


def lost(settings: Settings, steps: int) -> float:
    """The share of pairs at the least similarity that meet in no node after some steps.

    Every tree draws on the same ``tokens``, so the trees' chances are added up by how many of these agree.
    """
    j, n, out = settings.percent / 100, settings.tokens, 0.0
    for agree in range(n + 1):
        apart = 0.0
        for k in reversed([_children(settings, s) for s in range(steps)]):
            apart = (1 - (agree / n) ** 3 * (1 - apart)) ** k
        ways = sum(math.comb(settings.trees, r) * math.comb(n - settings.trees, agree - r) * apart**r for r in range(min(agree, settings.trees) + 1))
        out += j**agree * (1 - j) ** (n - agree) * ways
    return out


def _children(settings: Settings, step: int) -> int:
    return settings.children[min(step, len(settings.children) - 1)]


def _step(rows: DataFrame, settings: Settings, step: int) -> DataFrame:
    """Children of nodes: three tokens at places the node picks, as many times as the step has children."""
    at = lambda k: F.get("sig", F.pmod(F.xxhash64("node", "b", F.lit(k)), F.lit(settings.tokens)).cast("int"))
    more = rows.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(_children(settings, step)))))
    return more.select(F.xxhash64("node", "b", at(1), at(2), at(3)).alias("node"), "cid", "label", "sig")


def _blocks(rows: DataFrame, settings: Settings) -> DataFrame:
    """Nodes that stay large: every two blocks of such a node become a node."""
    half = settings.limit // 2
    count = F.ceil(F.col("n") / half).cast("int")
    own = rows.withColumn("k", F.pmod(F.xxhash64("cid"), count).cast("int"))
    other = own.withColumn("o", F.explode(F.sequence(F.lit(0), count - 1)))
    return other.select(F.xxhash64("node", F.least("k", "o"), F.greatest("k", "o"), F.lit("blocks")).alias("node"), "cid", "label", "sig")


def _promising(rows: DataFrame, settings: Settings, buckets: int) -> DataFrame:
    """Of each small node the classes with a class of another component that they may be linked to.

    ``sub`` names the set of classes left, so that trees that agree give one group.
    """

    def run(key: tuple, t: pa.Table) -> pa.Table:
        node, cid, label = (t.column(c).to_numpy() for c in ("node", "cid", "label"))
        sig = t.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, settings.tokens)
        order = np.lexsort([cid, node])
        node, cid, label, sig = node[order], cid[order], label[order], sig[order]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1, [len(node)]])
        subs, cids, labels = [], [], []
        for a, z in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            keep = np.zeros(z - a, bool)
            own_sig, own_label = sig[a:z], label[a:z]
            for i in np.flatnonzero(own_label != most_frequent(own_label)).tolist():  # any other pair is joined already
                near = (np.count_nonzero(own_sig == own_sig[i], axis=1) >= settings.agree) & (own_label != own_label[i])
                if near.any():
                    keep[i] = True
                    keep |= near
            if keep.any():
                own = np.flatnonzero(keep) + a
                subs.append(np.full(len(own), xxhash.xxh3_64_intdigest(cid[own].tobytes()) - (1 << 63)))
                cids.append(cid[own])
                labels.append(label[own])
        flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (subs, cids, labels)]
        return pa.table({"sub": flat[0], "cid": flat[1], "label": flat[2]})

    return rows.withColumn("bucket", F.pmod("node", F.lit(buckets))).groupBy("bucket").applyInArrow(run, "sub long, cid long, label long")


def most_frequent(label: np.ndarray) -> int:
    values, count = np.unique(label, return_counts=True)
    return int(values[np.argmax(count)])


def links_of(sets: list[np.ndarray], label: np.ndarray, percent: int, block: int = 512, width: int = 2048) -> list[tuple[int, int]]:
    """Places of linked sets that join components, each join once; intersections by matrix products, block by block.

    The largest component's members need no comparing with each other, so only the others have rows of their own.
    """
    n = len(sets)
    who = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1  # a shingle of one set meets none
    who, column = who[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    edges = np.searchsorted(column, np.arange(0, int(column.max(initial=-1)) + 1 + width, width))
    size = np.array([len(s) for s in sets])
    others = np.flatnonzero(label != most_frequent(label))
    root = {int(x): int(x) for x in label}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for begin in range(0, len(others), block):
        rows = others[begin : begin + block]
        both = np.zeros((len(rows), n), np.float32)
        for k, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
            x = np.zeros((n, width), np.float32)
            x[who[a:z], column[a:z] - k * width] = 1
            both += x[rows] @ x.T
        both = both.astype(np.float64)
        linked = 100 * both >= percent * (size[rows][:, None] + size[None, :] - both)
        linked[np.arange(len(rows)), rows] = False
        for i, j in np.argwhere(linked).tolist():
            a, b = find(int(label[rows[i]])), find(int(label[j]))
            if a != b:
                root[a] = b
                out.append((int(rows[i]), j))
    return out


def _compared(groups: DataFrame, texts: DataFrame, settings: Settings, buckets: int) -> DataFrame:
    """Links that join components, from groups of classes with their texts."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        sub, cid, label = (t.column(c).to_numpy() for c in ("sub", "cid", "label"))
        bodies = t.column("body")
        order = np.lexsort([cid, sub])
        edges = np.concatenate([[0], np.flatnonzero(np.diff(sub[order])) + 1, [len(order)]])
        first, second = [], []
        for a, z in zip(edges.tolist(), edges[1:].tolist(), strict=False):
            at = order[a:z]
            sets = [shingle_set(bodies[int(i)].as_py(), settings.shingle) for i in at]
            for i, j in links_of(sets, label[at], settings.percent):
                first.append(int(cid[at[i]]))
                second.append(int(cid[at[j]]))
        return pa.table({"a": pa.array(first, pa.int64()), "b": pa.array(second, pa.int64())})

    return groups.join(texts, "cid").withColumn("bucket", F.pmod("sub", F.lit(buckets))).groupBy("bucket").applyInArrow(run, "a long, b long")


def _buckets(spark, rows: int, each: int) -> int:
    """Buckets of about ``each`` rows, four for each shuffle partition at least."""
    return max(4 * common.partitions(spark), -(-rows // each))


def classes_and_links(df: DataFrame, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of all documents, classes with their least document, and links between classes."""
    spark = df.sparkSession
    docs = common.stored(sketches(df, settings), "sketches")
    classes = common.stored(_classes(docs), "classes")
    clash = classes.where("clash")  # of 1e11 sets a few hundred share the first 64 bits only
    if not clash.isEmpty():
        docs = common.stored(parted(docs, clash), "sketches")
        classes = common.stored(_classes(docs), "classes")
    # the root of each tree parts classes by one token
    tokens = classes.select("cid", F.posexplode("roots").alias("tree", "token"))
    rows = tokens.select(F.xxhash64("tree", "token").alias("node"), "tree", "cid")
    nodes = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    members = common.stored(rows.join(nodes, "node"), "members")
    active = members.select("cid").distinct()
    texts = common.stored(class_texts(df, classes.join(active, "cid", "left_semi"), settings), "texts")
    sig = classes.select("cid", "sig")
    stars = _stars(members.where(F.col("tree") < settings.star_trees).select("node", "cid").join(sig, "cid"), settings)
    alike = F.aggregate(F.zip_with("x", "y", lambda p, q: (p == q).cast("int")), F.lit(0), lambda acc, v: acc + v)
    near = stars.join(sig.select(F.col("cid").alias("a"), F.col("sig").alias("x")), "a").join(sig.select(F.col("cid").alias("b"), F.col("sig").alias("y")), "b").where(alike >= settings.agree).select("a", "b")
    links = common.stored(confirmed(near, texts, settings), "links")
    labels = components(links, settle=False)
    known = members.select("node", "cid").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    kept = common.stored(_told(known), "todo")
    groups, rows = [], kept.count()
    todo = kept.join(sig, "cid")
    for step in range(settings.steps + 1):
        groups.append(todo.where(F.col("n") <= settings.limit).drop("n"))
        large = todo.where(F.col("n") > settings.limit)
        if kept.where(F.col("n") > settings.limit).isEmpty():
            break
        if step == settings.steps:
            groups.append(_blocks(large, settings))
            break
        todo = kept = common.stored(_told(_step(large.drop("n"), settings, step)), "todo")
        rows += kept.count()
    small = groups[0].select("node", "cid", "label", "sig")
    for g in groups[1:]:
        small = small.union(g.select("node", "cid", "label", "sig"))
    left = common.stored(_promising(small, settings, _buckets(spark, rows, 20_000)).distinct(), "groups")
    more = common.stored(_compared(left, texts, settings, _buckets(spark, left.count(), 500)), "links")
    return docs, classes, links.union(more)


def resolve(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """``doc_id``, ``r1``, ``r2``, ``n_shingles``, ``component_id`` and ``kept`` for each document."""
    docs, classes, links = classes_and_links(df, settings)
    labels = components(links)
    named = classes.select("cid", "rep", "row").join(labels, "cid", "left").select("cid", "rep", "row", F.coalesce("label", "cid").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("component"), F.min("row").alias("first"))
    component = named.join(least, "label").select("cid", "component", "first")
    out = docs.select("doc_id", "r1", "r2", "n_shingles", "cid").join(component, "cid", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    nameless = F.col("cid").isNull() | (F.struct("r1", "r2") == F.col("first"))  # for components in which no row has an id
    kept = F.when(F.col("component_id").isNull(), nameless).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return out.select("doc_id", "r1", "r2", "n_shingles", "component_id", kept.alias("kept"))


def dedup(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """One document of each component, with all its columns; rows alike in id and text are one document."""
    one, two = common.free(df, "row1", "row2")
    r1, r2 = common.row_key("doc_id", "text")
    kept = resolve(df, settings).where("kept").select(F.col("r1").alias(one), F.col("r2").alias(two)).distinct()
    rows = df.withColumns({one: r1, two: r2}).join(kept, [one, two], "left_semi")
    others = [f"`{c}`" for c in df.columns if c not in ("doc_id", "text")]
    order = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    whole = F.struct(*(f"`{c}`" for c in df.columns))
    return rows.groupBy(one, two).agg(F.min_by(whole, order).alias("whole")).select("whole.*")


def digest(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return resolve(df, settings).select("doc_id", "n_shingles", "component_id", "kept")
