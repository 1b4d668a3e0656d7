"""Near-duplicates: MinHash with banding, signature and exact verification, and connected components.

Texts with one shingle set are one node, whatever their ids. A bucket's members are first compared with one of them (a
star), again with others while large buckets of several components are left, and then only pairs of different components
are compared, in blocks; so a large group of near copies doesn't become all its pairs, and no bucket is one task's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, bitmap, forget, maybe, written
from .components import connected_components

LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
CACHE = 400_000


@dataclass(frozen=True)
class Params:
    """Link texts with 100 * intersection >= percent * union of their shingle sets.

    A pair at 85 % misses all bands with probability (1 - 0.85 ** rows) ** bands: 3e-6 here. A signature may fall short of
    the threshold by `slack` standard deviations before the pair is dropped.
    """

    shingle: int = 5
    percent: int = 85
    bands: int = 40
    rows: int = 8
    slack: float = 4.5
    block: int = 512
    #: Stars are repeated, this often at most, while a member of the buckets with several components has more than `large`
    #: others to be compared with; as many comparisons take about as long as its signature.
    stars: int = 4
    large: int = 20_000
    seed: int = 7

    def __post_init__(self):
        if not 0 < self.bands <= 64:
            raise ValueError("1 to 64 bands: a key's low 6 bits tell its band")

    @property
    def least_match(self) -> int:
        """Equal signature bytes that a pair needs; unequal minima have equal bytes once in 256."""
        n, t = self.bands * self.rows, self.percent / 100
        t = max(0.0, t - self.slack * (t * (1 - t) / n) ** 0.5)
        return int(n * (t + (1 - t) / 256))


class Shingler:
    """The shingle set of a text as sorted distinct 64-bit hashes."""

    def __init__(self, k: int):
        self.k, self.words = k, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()  # splits at \\x20 and \\x09-\\x0D
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.words) > CACHE:
            self.words.clear()
        known = self.words
        try:
            ids = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            ids = [known[w] for w in words]
        w = np.array(ids, dtype=np.uint64)
        k = min(self.k, len(w))
        n = len(w) - k + 1
        h = w[:n] + np.uint64(k)
        for j in range(1, k):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w[j : n + j]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return np.unique(h ^ (h >> np.uint64(32)))


class Minima:
    """The minima of bands * rows universal hash functions a * x + b modulo 2 ** 64, as signature bytes and band keys."""

    def __init__(self, p: Params):
        r = np.random.default_rng(p.seed)
        n = p.bands * p.rows
        self.p = p
        self.a = r.integers(0, 1 << 63, n, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.b = r.integers(0, 1 << 63, n, dtype=np.uint64)[:, None] * np.uint64(2)

    def __call__(self, h: np.ndarray) -> tuple[bytes, np.ndarray]:
        low = None
        for i in range(0, len(h), 512):
            part = (self.a * h[None, i : i + 512] + self.b).min(axis=1)
            low = part if low is None else np.minimum(low, part)
        mixed = (low ^ (low >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        rows = mixed.reshape(self.p.bands, self.p.rows)
        key = np.zeros(self.p.bands, dtype=np.uint64)
        for j in range(self.p.rows):
            key = (key ^ (key >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + rows[:, j]
        key = (key ^ (key >> np.uint64(32))) & ~np.uint64(63) | np.arange(self.p.bands, dtype=np.uint64)
        return (mixed >> np.uint64(56)).astype(np.uint8).tobytes(), key.view(np.int64)


def signatures(docs: DataFrame, p: Params, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep, row (a hash of id and text), n_shingles, set_id (a digest of the set), sig, bands: one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, minima, seen = Shingler(p.shingle), Minima(p), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                b = batch.slice(at, 2000)
                n, sets, sigs, keys = [], [], [], []
                for t in b.column(0):
                    h = shingles(t.as_py() or "")
                    n.append(len(h))
                    sets.append(d := hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                    if len(h) and d not in seen:
                        if len(seen) > 5000:
                            seen.clear()
                        seen[d] = minima(h)
                    sig, key = seen[d] if len(h) else (b"", [])
                    sigs.append(sig)
                    keys.append(key)
                made = [pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*b.columns[1:], *made], names=[*b.schema.names[1:], "n_shingles", "set_id", "sig", "bands"])

    rows = docs.select("text", "doc_id", *keep, F.xxhash64("doc_id", "text").alias("row"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, kept + ", n_shingles long, set_id binary, sig binary, bands array<long>")


def _buckets(nodes: DataFrame) -> DataFrame:
    """key, node, c: the members of every bucket of two or more, and its size.

    Sizes are summed in parts first; a table of them is joined back, so that a hot bucket's rows are dealt to many tasks.
    """
    rows = nodes.select("node", F.explode("bands").alias("key"))
    sizes = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "sizes")
    out = written(rows.where(maybe(bitmap(sizes, "key"), F.col("key"))).join(sizes, "key").select("key", "node", "c"), "buckets")
    forget(sizes)
    return out


def _by_meetings(buckets: DataFrame) -> DataFrame:
    """The buckets with `met`: how many a member meets over all its buckets."""
    return buckets.join(buckets.groupBy("node").agg(F.sum("c").alias("met")), "node").select("key", "node", "met", F.col("node").alias("part"))


def _stars(members: DataFrame, order: F.Column) -> DataFrame:
    """Pairs (a, b): of each bucket of members (key, node, part) the pivot, which has the most of `order`, with all of other parts."""
    pivot = written(members.groupBy("key").agg(F.max(F.struct(order.alias("o"), (-F.col("node")).alias("less"), "part")).alias("p")).select("key", (-F.col("p.less")).alias("pivot"), F.col("p.part").alias("own")), "pivots")
    return members.join(pivot, "key").where("part <> own").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def _signed(pairs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """The pairs whose sizes and signatures allow a link."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    least = p.least_match

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint8).reshape(b.num_rows, -1) for k in (2, 3))
                keep = (x == y).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(keep)) for k in (0, 1)], names=["a", "b"])

    both = pairs.join(side("b"), "b").join(side("a"), "a").where(100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b"))
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """node, set: the full sets of the given nodes (node, row, set_id).

    One row of docs has each node's text; a bitmap of their hashes drops most other texts before they are moved, copies
    of one row are moved once, and a row of an equal hash is told apart by its set's digest.
    """
    k = p.shingle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                sets = [shingles(t.as_py() or "").tobytes() for t in b.column(2)]
                same = pa.array([hashlib.blake2b(x, digest_size=16).digest() == d.as_py() for x, d in zip(sets, b.column(1))], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0).filter(same), pa.array(sets, pa.binary()).filter(same)], names=["node", "set"])

    bits = bitmap(nodes, "row")
    near = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text").where(maybe(bits, F.col("row"))).distinct()
    return near.join(nodes, "row").select("node", "set_id", "text").mapInArrow(run, "node long, set binary")


def _linked(found: DataFrame, docs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose sizes, signatures and then full sets are similar enough, as a table of edges (u, v)."""
    pairs = written(_signed(found, nodes, p), "pairs")
    named = nodes.select("node", "row", "set_id").join(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "node", "left_semi")
    sets = written(_sets(docs, named, p), "sets")
    side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    percent = p.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in (x, y))
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], names=["u", "v"])

    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b")
    out = written(both.mapInArrow(run, "u long, v long"), "links")
    forget(pairs, sets)
    return out


def _split(buckets: DataFrame, parts: DataFrame) -> tuple[DataFrame, int, int]:
    """key, node, part, c of the buckets that hold several components, the number of rows, and of ordered pairs in a bucket."""
    known = buckets.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    span = written(known.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count(F.lit(1)).alias("c")).where("low <> high").select("key", "c"), "span")
    rows, pairs = span.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(F.col("c") * F.col("c")), F.lit(0))).first()
    return known.join(span, "key"), rows, pairs


def _rest(split: DataFrame, docs: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """Links (u, v) between the members of one bucket that are of different components so far, as a table.

    Buckets are cut in blocks of about p.block members by hash, and each pair of blocks is compared by itself. A first
    pass finds the members of a pair of blocks that have a likely partner there; only these get their full sets, and the
    second pass compares them exactly, so no pair is written that isn't a link.
    """
    last = F.floor((F.col("c") - 1) / p.block)
    block = F.pmod(F.xxhash64("node"), last + 1)
    dealt = split.select("key", "node", "part", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other"))
    dealt = dealt.select("node", "part", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("first"))
    signed = nodes.select("node", "n_shingles", "sig", "bands")
    place = ("node", "part", "key", "i", "j", "first")
    near = written(_compared(dealt.join(signed, "node").select(*place, "n_shingles", "sig", "bands"), p, "node long, part long, key long, i long, j long, first boolean"), "near")
    sets = written(_sets(docs, nodes.select("node", "row", "set_id").join(near.select("node").distinct(), "node", "left_semi"), p), "sets")
    full = near.join(signed, "node").join(sets, "node").select(*place, "n_shingles", "sig", "bands", "set")
    out = written(_compared(full, p, "u long, v long").distinct(), "links")
    forget(near, sets)
    return out


def _compared(dealt: DataFrame, p: Params, schema: str) -> DataFrame:
    """Of the rows of a pair of blocks those with a likely partner; with their sets the links between them.

    A pair is taken in the first band that it shares.
    """
    n, bands, least, percent, exact = p.bands * p.rows, p.bands, p.least_match, p.percent, "set" in dealt.columns

    def partners(rows: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        """Of each row's index the later ones that are likely."""
        part = np.array([r[1] for r in rows])
        size = np.array([r[6] for r in rows])
        sig = np.frombuffer(b"".join(r[7] for r in rows), dtype=np.uint8).reshape(-1, n)
        keys = np.array([r[8] for r in rows], dtype=np.int64).reshape(-1, bands)
        band, i, j = rows[0][2] & 63, rows[0][3], rows[0][4]
        first = np.array([r[5] for r in rows])  # in block i, not in block j
        for x in range(len(rows) - 1):
            y = np.arange(x + 1, len(rows))
            fit = (part[y] != part[x]) & (100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x]))
            if i != j:
                fit &= first[y] != first[x]
            y = y[fit]
            y = y[(sig[y] == sig[x]).sum(axis=1) >= least]
            y = y[np.argmax(keys[y] == keys[x], axis=1) == band]
            if len(y):
                yield x, y

    def likely(rows: list[tuple]) -> list[tuple]:
        found = set()
        for x, y in partners(rows):
            found.add(x)
            found.update(y.tolist())
        return [rows[k][:6] for k in sorted(found)]

    def links(rows: list[tuple]) -> list[tuple]:
        sets, out = [np.frombuffer(r[9], dtype=np.uint64) for r in rows], []
        for x, others in partners(rows):
            for y in others.tolist():
                same = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * same >= percent * (len(sets[x]) + len(sets[y]) - same):
                    out.append((min(rows[x][0], rows[y][0]), max(rows[x][0], rows[y][0])))
        return out

    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.bool_() if c.endswith("boolean") else pa.int64() for c in schema.split(", ")]

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, group, found = [], None, []
        take = links if exact else likely
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if (at := r[2:5]) != group:
                    if len(rows) > 1:
                        found += take(rows)
                    rows, group = [], at
                rows.append(r)
            if len(found) > 10_000:
                yield table(found)
                found = []
        if len(rows) > 1:
            found += take(rows)
        yield table(found)

    # a key and a pair of blocks have about 2 * p.block rows
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, schema)


def near_duplicates(docs: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, group_id, and the columns `keep`: one row per row of docs.

    A text's set is its distinct shingles of words (runs without \\x20 and \\x09-\\x0D, A-Z lower-cased); a shorter text is
    one shingle; an empty or null text has none and is linked with nothing. A row's component is that of its own text,
    whatever other rows have its id: component_id is the least doc_id of all rows that links reach, kept tells whether
    that is the row's own. group_id tells texts with copies or links apart and is null for all others. A null doc_id
    can't be named: its row takes part by its text, has a null component_id if no named row is reached, and is then
    kept. Rows that repeat a doc_id and text are alike. Long texts stay whole. An empty table gives no rows; other
    columns are ignored.
    """
    p = params or Params()
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *keep)
    signed = written(signatures(docs, p, keep), "signatures")
    least = signed.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "n_shingles", "sig", "bands")).alias("r"))
    nodes = written(least.select("set_id", "copies", "first_id", "r.*").withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = _buckets(nodes)
    met = buckets.select("node").distinct()
    tied = written(nodes.where(maybe(bitmap(met.select(F.xxhash64("node").alias("h")), "h"), F.xxhash64("node"))).drop("copies", "first_id").join(met, "node", "left_semi"), "tied")

    links = _linked(_stars(_by_meetings(buckets), F.col("met")), docs, tied, p)
    parts = connected_components(links)
    for k in range(p.stars + 1):
        split, rows, pairs = _split(buckets, parts)
        if not rows:
            break
        exact = pairs <= p.large * rows or k == p.stars
        more = _rest(split, docs, tied, p) if exact else _linked(_stars(split, F.xxhash64("node", F.lit(k))), docs, tied, p)
        links, parts = links.union(more), connected_components(links.union(more))
        if exact:
            break
    forget(buckets, tied)

    names = parts.join(nodes.select("node", "first_id"), "node").groupBy("component").agg(F.min("first_id").alias("name"))
    known = nodes.select("set_id", "node", "copies", "first_id").join(parts, "node", "left").where("copies > 1 or component is not null").join(names, "component", "left")
    known = written(known.select("set_id", F.coalesce("component", "node").alias("group_id"), F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("name")).alias("name")), "named")
    out = signed.select("doc_id", "n_shingles", "set_id", *keep).join(known, "set_id", "left")
    own = F.when(F.col("group_id").isNull(), F.col("doc_id")).otherwise(F.col("name"))
    out = out.select("doc_id", "n_shingles", own.alias("component_id"), "group_id", *keep)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"), "group_id", *keep)
