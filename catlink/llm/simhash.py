"""SimHash near-duplicates: exact pairs of close fingerprints by vantage-point search (operator 2).

A document's fingerprint has a bit set where more than half of its word shingles' XXH64 values
(seed 42) have it set.  Fingerprints link at ``radius`` or fewer differing bits; documents are
grouped by the links they can reach.

Search of distinct fingerprints only (exact copies collapse first, by a partial aggregate):

* *Shards by Hamming distance.*  The bits are dealt into ``radius + 1`` bands.  The distance over a
  band is a lower bound of the whole distance, and two fingerprints within the radius are at
  distance 0 over one band at least.  So the shards are the balls of radius 0 around each band
  value; a fingerprint overlaps the boundary of, and is sent to, ``radius + 1`` shards, and each
  close pair meets in one of them.
* *Large shards* are dealt anew in the same way over the bits outside their band.
* *Inside a shard* a vantage-point tree over the whole distance splits at the median distance and
  prunes a branch when the triangle bound excludes it.  A dual traversal of its leaves finds the
  members with any link; among those the search walks components: fingerprints
  already reached leave the tree, so a dense cluster costs about one query for each member and
  no pair is ever emitted, only one edge from each member to its component's first.

A fingerprint that many documents share, and the root of a large component, are looked up in a
broadcast of bounded size, so their rows are not gathered.

Cases: ids are integers, or text that reads as one; a null text is an empty one; texts without words
have fingerprint 0 and link like any other; a very long text is a block of its own, held whole by
one task; an empty table gives an empty result; repeated rows stay, each with its component; rows
without an id take part, and are no component's name unless nothing else is; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, lookup, ship
from catlink.llm.textbytes import LOWER, SPACE, blocks, fmix, text_buffer, words
from catlink.operators.components import connected_components

LEAF = 64
PARTS = 16
SHARD_ROWS = 20_000


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all rows' word shingles, row of each, shingles of each row)."""
    n = len(offsets) - 1
    start, end, row = words(data, offsets)
    if len(start) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n, np.int64)
    # one space after each word, nothing else between: every shingle is then one slice
    keep = ~SPACE[data]
    gap = end[end < len(data)]
    gap = gap[SPACE[data[gap]]]
    keep[gap] = True
    text = LOWER[data[keep]]
    place = np.cumsum(keep) - 1
    start, end = place[start], place[end - 1] + 1
    text[place[gap]] = 0x20
    count = np.bincount(row, minlength=n)
    last = np.cumsum(count)
    shingles = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(n), shingles)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    first = (last - count)[owner] + nth
    final = np.minimum(first + shingle, last[owner]) - 1
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], 42) for a, b in zip(start[first].tolist(), end[final].tolist(), strict=True)), np.uint64, len(owner))
    return hashes, owner, shingles


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = 4) -> np.ndarray:
    """Fingerprint of each row's bytes."""
    return fingerprint_family(data, offsets, shingle, 1)[0]


def fingerprint_family(data: np.ndarray, offsets: np.ndarray, shingle: int, members: int) -> list[np.ndarray]:
    """The fingerprint of each row's bytes and further ones, from the same hashes mixed anew."""
    hashes, owner, shingles = shingle_hashes(data, offsets, shingle)
    out = []
    for k in range(members):
        totals = np.zeros((len(shingles), 64), np.int64)
        for at in range(0, len(hashes), 1 << 16):
            some, rows = hashes[at : at + (1 << 16)], owner[at : at + (1 << 16)]
            if k:
                some = fmix(some + np.uint64(k))
            bits = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            edge = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            totals[rows[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
        over = totals * 2 > shingles[:, None]
        out.append(np.packbits(over, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64))
    return out


def sketches(data: np.ndarray, offsets: np.ndarray, words_each: int) -> np.ndarray:
    """64 bits for each row's set of word shingles: four bits of each of 16 minima; 0 for a text without words."""
    hashes, owner, shingles = shingle_hashes(data, offsets, words_each)
    out = np.zeros(len(shingles), np.uint64)
    if len(hashes) == 0:
        return out
    edge = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    key = fmix(np.arange(1, 2 * PARTS + 1, dtype=np.uint64))
    for k in range(PARTS):
        least = np.minimum.reduceat((hashes ^ key[2 * k]) * (key[2 * k + 1] | np.uint64(1)), edge)
        out[owner[edge]] |= (fmix(least) & np.uint64(15)) << np.uint64(4 * k)
    return out


def same_parts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the 16 parts of two sketches are equal."""
    x = a ^ b
    x = x | x >> np.uint64(1)
    x = (x | x >> np.uint64(2)) & np.uint64(0x1111111111111111)
    return PARTS - np.bitwise_count(x).astype(np.int64)


def least_parts(similarity: float, missed: float = 0.001) -> int:
    """The number of equal parts that sets of the similarity reach, but for ``missed`` of them."""
    p = similarity + (1 - similarity) / 16
    below, t = 0.0, 0
    while t < PARTS and (below := below + comb(PARTS, t) * p**t * (1 - p) ** (PARTS - t)) <= missed:
        t += 1
    return t


class VantageTree:
    """A vantage-point tree over 64-bit values and their Hamming distance, from which members can leave."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.alive = np.ones(len(values), bool)
        #: (vantage value, median distance, inside, outside), or the members of a leaf
        self.nodes: list[tuple | np.ndarray] = []
        self.left: list[int] = []
        self.parent: list[int] = []
        self.leaf_of = np.zeros(len(values), np.int64)
        self._build(np.arange(len(values)), -1)

    def _build(self, members: np.ndarray, parent: int) -> int:
        me = len(self.nodes)
        self.nodes.append(members)
        self.left.append(len(members))
        self.parent.append(parent)
        if len(members) > LEAF:
            vantage = self.values[members[len(members) // 2]]
            far = np.bitwise_count(self.values[members] ^ vantage)
            middle = int(np.partition(far, len(far) // 2)[len(far) // 2])
            inside = far < middle
            if inside.any():
                self.nodes[me] = (vantage, middle, self._build(members[inside], me), self._build(members[~inside], me))
                return me
        self.leaf_of[members] = me
        return me

    def leave(self, members: np.ndarray) -> None:
        self.alive[members] = False
        for leaf, n in zip(*np.unique(self.leaf_of[members], return_counts=True), strict=True):
            node = int(leaf)
            while node >= 0:
                self.left[node] -= int(n)
                node = self.parent[node]

    def within(self, value: np.uint64, radius: int) -> np.ndarray:
        """Members still in the tree within the radius of a value."""
        found, open_ = [], [0]
        while open_:
            node = open_.pop()
            if self.left[node] == 0:
                continue
            x = self.nodes[node]
            if isinstance(x, tuple):
                vantage, middle, inside, outside = x
                far = int(np.bitwise_count(vantage ^ value))
                if far - radius < middle:  # some member below the median may be near
                    open_.append(inside)
                if far + radius >= middle:
                    open_.append(outside)
            else:
                x = x[self.alive[x]]
                found.append(x[np.bitwise_count(self.values[x] ^ value) <= radius])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def linked(values: np.ndarray, radius: int, marks: np.ndarray | None = None, least: int = 0) -> np.ndarray:
    """Which values have another within the radius: a dual traversal of a vantage-point tree's leaves.

    A pair of leaves is skipped when their ranges of distances to a common vantage point are farther
    apart than the radius; other pairs are compared as blocks.  With sketches as ``marks``, only pairs with
    ``least`` equal parts count.
    """
    tree = VantageTree(values)
    out = np.zeros(len(values), bool)
    leaves = [x for x in tree.nodes if not isinstance(x, tuple) and len(x)]
    vantages = [x[0] for x in tree.nodes if isinstance(x, tuple)][:8]
    low, high = np.zeros((len(leaves), len(vantages)), int), np.zeros((len(leaves), len(vantages)), int)
    for i, leaf in enumerate(leaves):
        for k, v in enumerate(vantages):
            far = np.bitwise_count(values[leaf] ^ v)
            low[i, k], high[i, k] = far.min(), far.max()
    for i, leaf in enumerate(leaves):
        rest = np.arange(i, len(leaves))
        if len(vantages):
            rest = rest[((low[rest] - radius <= high[i]) & (high[rest] + radius >= low[i])).all(axis=1)]
        every = np.concatenate([leaves[j] for j in rest])
        for at in range(0, len(every), 1 << 16):  # bounds the block, whatever the shard's size
            others = every[at : at + (1 << 16)]
            near = np.bitwise_count(values[leaf][:, None] ^ values[others][None, :]) <= radius
            if at == 0:
                near[np.arange(len(leaf)), np.arange(len(leaf))] = False  # the leaf itself stands first
            if marks is not None:
                a, b = np.nonzero(near)
                far = same_parts(marks[leaf[a]], marks[others[b]]) < least
                near[a[far], b[far]] = False
            out[leaf] |= near.any(axis=1)
            out[others] |= near.any(axis=0)
    return out


def link_shard(values: np.ndarray, radius: int, marks: np.ndarray | None = None, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(member, first of its component) for every member that has a link, as places; values, or values with their marks, are distinct."""
    place = np.flatnonzero(linked(values, radius, marks, least))
    values, marks = values[place], None if marks is None else marks[place]
    tree = VantageTree(values)
    member, first = [], []
    for seed in range(len(values)):
        if not tree.alive[seed]:
            continue
        tree.leave(np.array([seed]))
        reached, todo = [seed], [seed]
        while todo:
            at = todo.pop()
            new = tree.within(values[at], radius)
            if marks is not None:
                new = new[same_parts(marks[new], marks[at]) >= least]
            if len(new):
                tree.leave(new)
                reached += new.tolist()
                todo += new.tolist()
        if len(reached) > 1:
            member.append(place[reached])
            first.append(np.full(len(reached), place[seed]))
    return (np.concatenate(member), np.concatenate(first)) if member else (place[:0], place[:0])


def _fingerprint_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in blocks(offsets):
                made = fingerprints(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(made.view(np.int64))], names=["_i", "_f"])

    return run


def _link_shards(radius: int, least: int | None):
    """Streams a partition sorted by shard; holds one shard at a time.  Edges are of values, or of sketches if these decide too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def close():
            values = np.concatenate([x for x, _ in held])
            if least is None:
                values = nodes = np.unique(values)
                member, first = link_shard(values, radius)
            else:
                nodes = np.concatenate([x for _, x in held])
                order = np.lexsort((nodes, values))
                values, nodes = values[order], nodes[order]
                new = np.append(True, (values[1:] != values[:-1]) | (nodes[1:] != nodes[:-1]))
                values, nodes = values[new], nodes[new]
                member, first = link_shard(values, radius, nodes, least)
            member, first = nodes[member], nodes[first]
            other = member != first
            return pa.RecordBatch.from_arrays([pa.array(x[other].view(np.int64)) for x in (member, first)], names=["src", "dst"])

        for batch in batches:
            shard, value, node = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            if len(shard) == 0:
                continue
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if shard[a] != last:
                    if held:
                        yield close()
                    last, held = shard[a], []
                held.append((value[a:b].view(np.uint64), node[a:b].view(np.uint64)))
        if held:
            yield close()

    return run


def _bands(start: int, width: int, parts: int) -> list[tuple[int, int]]:
    edges = [start + width * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:], strict=False))


def _slice(value: Column, low: int, high: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def close_links(distinct: DataFrame, value: str, radius: int, shard_rows: int = SHARD_ROWS, family: str | None = None, sketch: str | None = None, least: int = 0) -> DataFrame:
    """Edges (src, dst) that connect the distinct 64-bit values of each component of the radius graph.

    family: a column of whole numbers; values with different ones are in different shards.
    sketch: a column of ``sketches``; rows link only if ``least`` of their parts are equal as well, and the
    edges are of sketches.
    """
    v, k = F.col(value), F.col(family) if family else F.lit(0)
    bands = _bands(0, 64, radius + 1)
    shards = F.array(*[F.xxhash64(k, F.lit(i), _slice(v, a, b)) for i, (a, b) in enumerate(bands)])
    dealt = distinct.select((F.col(sketch) if sketch else F.lit(0).cast("long")).alias("_k"), v.alias("_f"), F.posexplode(shards).alias("_band", "_s"))
    large = dealt.groupBy("_s").count().filter(F.col("count") > shard_rows).select("_s", F.lit(True).alias("_large"))
    # over the other bits, rotated so that the band's own come last
    anew = []
    for i, (a, b) in enumerate(bands):
        rest = [x for x in range(64) if not a <= x < b]
        inner = []
        for lo, hi in _bands(0, len(rest), radius + 1):
            mask = sum(1 << x for x in rest[lo:hi])
            inner.append(F.xxhash64("_s", F.lit(lo), F.col("_f").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
        anew.append(F.when(F.col("_band") == i, F.array(*inner)))
    finer = F.when(F.col("_large"), F.coalesce(*anew)).otherwise(F.array("_s"))
    # few: at most one for each ``shard_rows`` rows
    shard = dealt.join(F.broadcast(large), "_s", "left").select(F.explode(finer).alias("_s"), "_f", "_k")
    shard = shard.repartition("_s").sortWithinPartitions("_s")
    return shard.mapInArrow(_link_shards(radius, least if sketch else None), "src long, dst long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 4, radius: int = 4, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Returns (id, fingerprint long, component), one row for each input row."""
    ship(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("_t"))
    prints = checkpoint(own.mapInArrow(_fingerprint_rows(shingle), "_i long, _f long"))
    groups = checkpoint(prints.groupBy("_f").agg(F.min("_i").alias("_least"), F.count("*").alias("_n")))
    size = groups.agg(F.count("*").alias("kinds"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).first()
    nodes = connected_components(close_links(groups.select("_f"), "_f", radius, shard_rows)).withColumnRenamed("node", "_f")
    grouped = checkpoint(groups.join(nodes, "_f", "left").withColumn("_root", F.coalesce("component", "_f")).select("_f", "_root", "_least", "_n"))
    roots = grouped.groupBy("_root").agg(F.min("_least").alias("component_id"), F.count("*").alias("_m"))
    named = lookup(grouped, roots, "_root", size["kinds"], "_m").select("_f", "component_id", "_n")
    return lookup(prints, named, "_f", size["rows"]).select(F.col("_i").alias(id_col), F.col("_f").alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 2, radius: int = 8, members: int = 4, words_each: int = 5, similarity: float = 0.8
) -> DataFrame:
    """The rows of ``docs`` without those that are near copies of a row that stays.

    Texts are candidates for each other when links of any of ``members`` fingerprints reach from one
    to the other.  A link also needs sketches of the ``words_each``-word shingles (16 minima, four bits each) that agree
    as often as those of similar texts do (but for 1 in 1,000 of them at the similarity itself): close
    fingerprints alone join more and more unlike texts as the table grows.  Texts with one sketch are one
    node.  In each group of candidates, by id and then by hash of the text, a text stays
    unless its ``words_each``-word shingles have a Jaccard similarity of ``similarity`` with those of
    one that stays.  Shingles are compared as 64-bit hashes; texts without words are equal.

    Rows repeated with equal id and text are one document; rows without an id come after all others.
    The texts of one group of candidates stream through one task in order, which holds the shingle hashes of
    those that stay; copies of one text are one entry there, so a large group of exact copies is not.
    """
    ship(docs.sparkSession)
    key, digest = F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    own = docs.select(key.alias("_i"), F.col(text_col).alias("_t"), digest.alias("_h"))
    names = [f"_f{k}" for k in range(members)]
    prints = own.mapInArrow(_family(shingle, names, words_each), ", ".join(f"{c} long" for c in ["_i", "_h", "_k", *names]))
    # one row for each text first, so that a large group of copies is summed where it lies
    texts = checkpoint(prints.groupBy("_h", "_k", *names).agg(F.min("_i").alias("_i")))
    # all families in one search, told apart by their number
    every = texts.select("_k", F.explode(F.array(*[F.struct(F.lit(k).alias("_m"), F.col(c).alias("_v")) for k, c in enumerate(names)])).alias("x")).select("_k", "x._m", "x._v")
    roots = connected_components(close_links(every, "_v", radius, family="_m", sketch="_k", least=least_parts(similarity)))
    roots = roots.withColumnsRenamed({"node": "_k", "component": "_root"})
    grouped = checkpoint(texts.select("_i", "_h", "_k").join(roots, "_k", "left").select("_i", "_h", F.coalesce("_root", "_k").alias("_root")))
    several = grouped.groupBy("_root").agg(F.count("*").alias("_n"), F.lit(True).alias("_several")).filter("_n > 1")
    asked = lookup(grouped, several, "_root", grouped.count()).drop("_several")
    sent = own.join(asked, ["_i", "_h"]).select("_root", "_i", "_h", "_t").mapInArrow(_shingle_sets(words_each), "_root long, _i long, _h long, _s binary")
    sent = sent.repartition("_root").sortWithinPartitions("_root", "_i", "_h")
    gone = sent.mapInArrow(_near_copies(similarity), "_h long")
    kept = grouped.select("_i", "_h").join(gone, "_h", "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")  # whatever the columns are called
    rows = docs.select(whole, key.alias("_i"), digest.alias("_h")).join(kept, ["_i", "_h"], "left_semi")
    return rows.dropDuplicates(["_i", "_h"]).select("_row.*")


def _family(shingle: int, names: list[str], words_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("_t"))
            for a, b in blocks(offsets):
                data_, offsets_ = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                made = [sketches(data_, offsets_, words_each), *fingerprint_family(data_, offsets_, shingle, len(names))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in ("_i", "_h")], *[pa.array(x.view(np.int64)) for x in made]], names=["_i", "_h", "_k", *names])

    return run


def _shingle_sets(shingle: int):
    """Sorted distinct shingle hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("_t"))
            for a, b in blocks(offsets):
                hashes, _, count = shingle_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle)
                ends = np.cumsum(count)
                sets = [np.unique(hashes[e - c : e]).tobytes() for e, c in zip(ends.tolist(), count.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in ("_root", "_i", "_h")], pa.array(sets, pa.binary())], names=["_root", "_i", "_h", "_s"])

    return run


class Representatives:
    """The texts of a group that stay, found by the smallest shingles that similar sets must share."""

    def __init__(self, similarity: float):
        self.similarity = similarity
        self.sets: list[np.ndarray] = []
        self.by_hash: dict[int | None, list[int]] = {}

    def covers(self, own: np.ndarray) -> bool:
        """Whether one of them is similar to a set of sorted hashes; if none is, the set becomes one."""
        n = len(own)
        # sets with the similarity share ceil(similarity n) hashes at least, so one of the others and one more
        first = own[: n - int(np.ceil(self.similarity * n - 1e-9)) + 1].tolist() if n else [None]
        tried: set[int] = set()
        for h in first:
            for j in self.by_hash.get(h, ()):
                if j in tried:
                    continue
                tried.add(j)
                other = self.sets[j]
                if n == 0:
                    return True
                if min(n, len(other)) < self.similarity * max(n, len(other)) - 1e-9:
                    continue
                same = len(np.intersect1d(own, other, assume_unique=True))
                if same >= self.similarity * (n + len(other) - same) - 1e-9:
                    return True
        for h in first:
            self.by_hash.setdefault(h, []).append(len(self.sets))
        self.sets.append(own)
        return False


def _near_copies(similarity: float):
    """Streams a partition sorted by group, id and hash; holds the texts of one group that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, stay, before = None, Representatives(similarity), None
        for batch in batches:
            roots, digests, gone = batch.column("_root").to_pylist(), batch.column("_h").to_pylist(), []
            for root, h, s in zip(roots, digests, batch.column("_s"), strict=True):
                if root != last:
                    last, stay, before = root, Representatives(similarity), None
                if h != before and stay.covers(np.frombuffer(s.as_py(), np.uint64)):  # repeated rows stand together
                    gone.append(h)
                before = h
            yield pa.RecordBatch.from_arrays([pa.array(gone, pa.int64())], names=["_h"])

    return run
