"""Co-occurrence networks, traversal, ranks, matrices and information measures.

A membership is (item, member); edges are (src, dst).  Iterative operators checkpoint each round in
the cluster's shared folder and look at the driver only at one-row convergence checks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, numbered, ship


def membership_of(x: DataFrame, id_col: str, list_col: str) -> DataFrame:
    """(item, member) from a comma-separated list of items."""
    return x.select(F.explode(F.split(list_col, ",")).alias("item"), F.col(id_col).alias("member")).filter("trim(item) <> ''").distinct()


#: Memberships of one block of nodes, about; blocks at least; pairs of classes that are counted at once, about; nodes in one list of seconds; memberships in one pack.
BLOCK_ROWS, LEAST_BLOCKS, PAIRS, PIECE, PACK = 1_000_000, 8, 1 << 20, 512, 1 << 18


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after another."""
    return np.arange(int(length.sum())) + np.repeat(start - (np.cumsum(length) - length), length)


def _twins(nodes: np.ndarray, items: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each node, nodes by class, where each class begins): nodes of a class are of one kind and have the same items.

    Classes are found by a sum of hashes and confirmed item by item.
    """
    order = np.lexsort((items, nodes))
    k, count = items[order], np.bincount(nodes, minlength=len(kind))
    start = np.cumsum(count) - count
    mark = (k.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mark = (mark ^ (mark >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    marks = np.add.reduceat(mark ^ (mark >> np.uint64(32)), start)
    by = np.lexsort((marks, count, kind))
    same = np.ones(len(by) - 1, bool)
    for key in (marks, count, kind):
        same &= key[by[1:]] == key[by[:-1]]
    told = np.flatnonzero(same)
    if len(told):
        length = count[by[told]]
        equal = k[_ranges(start[by[told]], length)] == k[_ranges(start[by[told + 1]], length)]
        same[told] = np.logical_and.reduceat(equal, np.cumsum(length) - length)
    new = np.append(True, ~same)
    class_of = np.empty(len(by), np.int64)
    class_of[by] = np.cumsum(new) - 1
    return class_of, by, np.append(np.flatnonzero(new), len(by))


def _lists(names: pa.Array, s: tuple, d: tuple, value: np.ndarray, symmetric: bool) -> Iterator[pa.RecordBatch]:
    """Rows (src, dst, value) of two lists, each pair of which is an edge, in batches of bounded pairs; s and d are (nodes, starts, lengths)."""
    done, i = np.cumsum(s[2] * d[2]), 0
    listed = lambda x, i, j: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(x[2][i:j])), pa.int32()), names.take(pa.array(x[0][_ranges(x[1][i:j], x[2][i:j])])))
    while i < len(done):
        j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + PAIRS // 8, side="right")))
        src, dst, v = listed(s, i, j), listed(d, i, j), pa.array(value[i:j])
        yield pa.RecordBatch.from_arrays([src, dst, v], names=["src", "dst", "value"])
        if symmetric:
            yield pa.RecordBatch.from_arrays([dst, src, v], names=["src", "dst", "value"])
        i = j


def _count_cell(rows: pa.Table, diagonal: bool, symmetric: bool) -> Iterator[pa.RecordBatch]:
    """Edges between the nodes of two blocks, or inside one, as lists, from rows (_side, k, n) or (_side, k, n, d).

    The value is the number of shared items or, where rows bring the degrees d of their nodes, the Jaccard similarity.
    """
    items = rows["k"].combine_chunks().dictionary_encode().indices.to_numpy()
    nodes = rows["n"].combine_chunks().dictionary_encode()
    order = pc.array_sort_indices(nodes.dictionary)
    names, place = nodes.dictionary.take(order), np.argsort(order.to_numpy())
    nodes, first = place[nodes.indices.to_numpy()], rows["_side"].to_numpy() == 0
    second = first if diagonal else ~first
    if not first.any() or not second.any():
        return
    # nodes with the same items are counted once
    degree, side = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    side[nodes] = first
    if "d" in rows.column_names:
        degree[nodes] = rows["d"].to_numpy()
    class_of, members, begin = _twins(nodes, items, degree * 2 + side)
    size, head = np.diff(begin), members[begin[:-1]]
    degree, at = degree[head], class_of[nodes]
    lead = head[at] == nodes
    valued = (lambda x, y, n: n / (degree[x] + degree[y] - n)) if "d" in rows.column_names else (lambda x, y, n: n)
    if diagonal:
        # inside a class: each node with those after it in its piece, then each piece with all before it
        c = np.repeat(np.arange(len(size)), size)
        count, here = np.bincount(at[lead], minlength=len(size)), np.arange(len(members))
        end = np.minimum(begin[c + 1], here + PIECE - (here - begin[c]) % PIECE)
        some = np.flatnonzero(end > here + 1)
        yield from _lists(names, (members, some, np.ones_like(some)), (members, some + 1, end[some] - some - 1), valued(c[some], c[some], count[c[some]]), symmetric)
        later = np.flatnonzero((here > begin[c]) & ((here - begin[c]) % PIECE == 0))
        yield from _lists(names, (members, begin[c[later]], later - begin[c[later]]), (members, later, end[later] - later), valued(c[later], c[later], count[c[later]]), symmetric)
    first, second = first & lead, second & lead
    # the second block by item; the first by class, so that all rows of a class are counted together
    near, item = at[second], items[second]
    many = np.bincount(item, minlength=int(items.max()) + 1)
    near, start = near[np.argsort(item, kind="stable")], np.cumsum(many) - many
    by_class = np.argsort(at[first], kind="stable")
    own, item = at[first][by_class], items[first][by_class]
    count = many[item]
    done = np.cumsum(count)
    ends = np.flatnonzero(np.append(own[1:] != own[:-1], True)) + 1
    bits, i = np.int64(len(size).bit_length()), 0
    while i < len(own):
        # up to the last class that stays below PAIRS, one class at least
        before = done[i - 1] if i else 0
        k = np.searchsorted(ends, np.searchsorted(done, before + PAIRS, side="right"), side="right") - 1
        j = int(ends[max(k, np.searchsorted(ends, i, side="right"))])
        x, y = np.repeat(own[i:j], count[i:j]), near[_ranges(start[item[i:j]], count[i:j])]
        if diagonal:
            x, y = x[x < y], y[x < y]
        pair = x << bits | y
        pair.sort()
        ends_here = np.flatnonzero(np.append(pair[1:] != pair[:-1], len(pair) > 0))
        weight, pair = np.diff(ends_here, prepend=-1), pair[ends_here]
        x, y = pair >> bits, pair & ((np.int64(1) << bits) - 1)
        value = valued(x, y, weight)
        # one value first, as it is most often; the others are brought together
        usual = value == value[len(value) // 2] if len(value) else np.zeros(0, bool)
        rest = np.flatnonzero(~usual)
        for part in (np.flatnonzero(usual), rest[np.lexsort((value[rest], x[rest]))]):
            yield from _listed(names, members, begin, x[part], y[part], value[part], symmetric)
        i = j


def _listed(names: pa.Array, members: np.ndarray, begin: np.ndarray, x: np.ndarray, y: np.ndarray, value: np.ndarray, symmetric: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of classes as lists: all nodes of x with those of the following y that have the same value, some at a time."""
    done, i = np.cumsum(begin[y + 1] - begin[y]), 0
    while i < len(x):
        j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + PAIRS, side="right")))
        size = begin[y[i:j] + 1] - begin[y[i:j]]
        to = members[_ranges(begin[y[i:j]], size)]
        new = np.flatnonzero(np.append(True, (x[i + 1 : j] != x[i : j - 1]) | (value[i + 1 : j] != value[i : j - 1])))
        low = (np.cumsum(size) - size)[new]
        high = np.append(low[1:], len(to))
        pieces = -(-(high - low) // PIECE)
        group = np.repeat(np.arange(len(new)), pieces)
        at = low[group] + _ranges(np.zeros_like(pieces), pieces) * PIECE
        one = x[i:j][new][group]
        yield from _lists(names, (members, begin[one], begin[one + 1] - begin[one]), (to, at, np.minimum(high[group], at + PIECE) - at), value[i:j][new][group], symmetric)
        i = j


def _rows_of(batches: list[pa.RecordBatch]) -> pa.Table:
    """Rows with a pack, or with a list of nodes (n, d), as one row for each node."""
    table = pa.Table.from_batches(batches)
    if "_pack" in table.column_names:
        read = [(side, pq.read_table(pa.BufferReader(p.as_buffer()))) for side, p in zip(table["_side"].to_pylist(), table["_pack"], strict=True)]
        return pa.concat_tables([t.append_column("_side", pa.array(np.full(len(t), side, np.int32))) for side, t in read])
    if "_nodes" not in table.column_names:
        return table
    listed = table["_nodes"].combine_chunks()
    at, each = pc.list_parent_indices(listed), listed.flatten()
    return pa.table({"_side": table["_side"].take(at), "k": table["k"].take(at), "n": each.field("n"), "d": each.field("d")})


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_a, _pack): rows (_a, k, n) of a partition sorted by them, some thousands as one Parquet file in a few bits a row."""

    def packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table, sink = pa.Table.from_batches(rows), pa.BufferOutputStream()
        whole = pa.types.is_integer(table.schema.field("n").type)
        pq.write_table(table.select(["k", "n"]), sink, compression="zstd", use_dictionary=["k"] if whole else True, column_encoding={"n": "DELTA_BINARY_PACKED"} if whole else None, write_statistics=False)
        return pa.record_batch({"_a": table["_a"].combine_chunks().slice(0, 1), "_pack": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    held, last = [], None
    for batch in batches:
        a = batch.column("_a").to_numpy()
        cuts = [0, *(np.flatnonzero(a[1:] != a[:-1]) + 1).tolist(), len(a)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i == j:
                continue
            if held and (a[i] != last or sum(map(len, held)) + j - i > PACK):
                yield packed(held)
                held = []
            last = a[i]
            held.append(batch.slice(i, j - i))
    if held:
        yield packed(held)


def _count_cells(blocks: int, symmetric: bool):
    """Streams a partition sorted by cell; holds the rows of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            cell = batch.column("_cell").to_numpy()
            cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(cell)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if cell[a] != last:
                    if held:
                        yield from _count_cell(_rows_of(held), last // blocks == last % blocks, symmetric)
                    last, held = int(cell[a]), []
                held.append(batch.slice(a, b - a))
        if held:
            yield from _count_cell(_rows_of(held), last // blocks == last % blocks, symmetric)

    return run


def _met(rows: DataFrame, blocks: int, kind: str, value: str, symmetric: bool) -> DataFrame:
    """(src, dst, value) from rows that have their block ``_a``: a row goes to the cells of its block, and lists of edges are taken apart last.

    Lists keep edges of one node together, and so does what is written of them: it repeats itself and packs well.
    """
    columns = [c for c in rows.columns if c != "_a"]
    dealt = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b"))
    cell = F.least("_a", "_b") * blocks + F.greatest("_a", "_b")
    dealt = dealt.select(cell.cast("long").alias("_cell"), (F.col("_a") > F.col("_b")).cast("int").alias("_side"), *columns)
    dealt = dealt.repartition(blocks * (blocks + 1), "_cell").sortWithinPartitions("_cell")
    lists = dealt.mapInArrow(_count_cells(blocks, symmetric), f"src array<{kind}>, dst array<{kind}>, value {value}")
    pairs = lists.select(F.explode("src").alias("src"), "dst", "value").select("src", F.explode("dst").alias("dst"), "value")
    return pairs if symmetric else pairs.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "value")


def _block(node: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(blocks))


def shared_edges(membership: DataFrame, node: str, over: str, symmetric: bool = False) -> DataFrame:
    """(src, dst, weight): pairs of nodes that share an item, with the number of shared items; src < dst unless symmetric.

    Nodes are dealt into blocks and a task counts the pairs of two blocks, so memberships are shuffled,
    packed and once for each block, and pairs never are.
    """
    ship(membership.sparkSession)
    m = membership.select(F.col(over).alias("k"), F.col(node).alias("n")).dropna()
    blocks = max(LEAST_BLOCKS, -(-m.count() // BLOCK_ROWS))
    # a block's rows meet in one partition, where repeats are dropped without another shuffle
    sorted_ = m.withColumn("_a", _block("n", blocks)).repartition(blocks, "_a").dropDuplicates(["_a", "k", "n"]).sortWithinPartitions("_a", "k", "n")
    packs = checkpoint(sorted_.mapInArrow(_pack, "_a long, _pack binary"))
    return _met(packs, blocks, m.schema["n"].dataType.simpleString(), "long", symmetric).withColumnRenamed("value", "weight")


def both_ways(edges: DataFrame) -> DataFrame:
    e = edges.select("src", "dst")
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree) of an undirected graph."""
    return both_ways(edges).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))


def breadth_first(edges: DataFrame, source, max_depth: int = 1_000_000) -> DataFrame:
    """(node, distance, parent): distances from a source; the parent is the smallest node one step nearer, and null for the source."""
    spark = edges.sparkSession
    e = checkpoint(both_ways(edges))
    kind = e.schema["src"].dataType.simpleString()
    start = spark.range(1).select(F.lit(source).cast(kind).alias("node"), F.lit(0).cast("long").alias("distance"), F.lit(None).cast(kind).alias("parent"))
    before, frontier = None, checkpoint(start)
    levels = [frontier]
    for depth in range(1, max_depth + 1):
        step = frontier.select(F.col("node").alias("src")).join(e, "src").groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
        # neighbours of a level are in it, in the one before or in the next: older levels aren't read again
        near = frontier.select("node") if before is None else frontier.select("node").unionByName(before.select("node"))
        before, frontier = frontier, checkpoint(step.join(near, "node", "left_anti").select("node", F.lit(depth).cast("long").alias("distance"), "parent"))
        if frontier.isEmpty():
            break
        levels.append(frontier)
        if len(levels) > 64:  # bounds the plan of a long path
            levels = [checkpoint(reduce(DataFrame.unionByName, levels))]
    return reduce(DataFrame.unionByName, levels)


def shortest_path(edges: DataFrame, membership: DataFrame | None, source, target, max_depth: int = 1000) -> DataFrame:
    """(step, node, via): a shortest path, found from both ends; via is the smallest item shared with the node before.

    Both searches grow in turn until they meet; the meeting node and the parents are the smallest
    ones, so the path is deterministic.  No path gives no rows.
    """
    e = checkpoint(both_ways(edges))
    kind = e.schema["src"].dataType.simpleString()
    one = lambda x: edges.sparkSession.range(1).select(F.lit(x).cast(kind).alias("node"), F.array(F.lit(x).cast(kind)).alias("path"))
    sides = [[checkpoint(one(source))] * 2, [checkpoint(one(target))] * 2]
    meet = None
    for depth in range(max_depth):
        both = sides[0][0].join(sides[1][0].select("node", F.col("path").alias("back")), "node").orderBy(F.size("path") + F.size("back"), "node").limit(1)
        meet = both.select("path", "back").first()
        if meet is not None:
            break
        seen, frontier = sides[depth % 2]
        step = frontier.select(F.col("node").alias("src"), "path").join(e, "src").groupBy(F.col("dst").alias("node")).agg(F.min(F.struct("src", "path")).alias("m"))
        frontier = step.join(seen.select("node"), "node", "left_anti").select("node", F.concat("m.path", F.array("node")).alias("path"))
        frontier = checkpoint(frontier)
        if frontier.isEmpty():
            break
        sides[depth % 2] = [checkpoint(seen.unionByName(frontier)), frontier]
    path = meet["path"] + meet["back"][-2::-1] if meet is not None else []
    out = edges.sparkSession.createDataFrame([(i, n) for i, n in enumerate(path)], f"step int, node {kind}")
    if membership is None:
        return out
    before = out.select((F.col("step") + 1).alias("step"), F.col("node").alias("b"))
    m = membership.select("item", "member").distinct()
    hops = out.join(before, "step").join(m.withColumnRenamed("member", "node"), "node").join(m.select("item", F.col("member").alias("b")), ["item", "b"])
    return out.join(hops.groupBy("step").agg(F.min("item").alias("via")), "step", "left")


def depth_first_tree(edges: DataFrame, source) -> DataFrame:
    """(node, depth, parent): what a depth-first search reaches, as a spanning tree.

    The visiting order of a depth-first search is sequential by nature; this returns the same nodes,
    with the tree of smallest parents and the depths along it.
    """
    return breadth_first(edges, source).select("node", F.col("distance").alias("depth"), "parent")


def page_rank(edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-8, rounds: int = 100) -> DataFrame:
    """(node, rank): rows normalised, mass of nodes without edges spread evenly, until the L1 change is below the tolerance.

    As many rounds as given at most; on convergence the iterate before the last is returned.
    """
    e = both_ways(edges)
    out = e.groupBy("src").agg(F.count("*").alias("d"))
    links = checkpoint(e.join(out, "src"))
    nodes = checkpoint(edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct())
    n = nodes.count()
    if n == 0:
        return nodes.withColumn("rank", F.lit(0.0))
    now = nodes.withColumn("rank", F.lit(1.0 / n))
    for i in range(rounds):
        given = now.withColumnRenamed("node", "src").join(links, "src").groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("rank") / F.col("d")).alias("got"))
        given = checkpoint(given)
        dangling = 1.0 - (given.agg(F.sum("got")).first()[0] or 0.0)
        new = nodes.join(given, "node", "left").select("node", (F.lit((1 - damping) / n) + damping * (F.coalesce("got", F.lit(0.0)) + dangling / n)).alias("rank"))
        new = checkpoint(new)
        if tolerance > 0 and (new.withColumnRenamed("rank", "r2").join(now, "node").agg(F.sum(F.abs(F.col("r2") - F.col("rank")))).first()[0] or 0.0) < tolerance:
            break
        now = new
    return now


def indexed_nodes(nodes: DataFrame, name: str = "node") -> DataFrame:
    """(node, i): dense numbers from 0 in the order of the nodes."""
    return numbered(nodes.select(name).distinct(), [name], "i").withColumn("i", F.col("i") - 1)


def adjacency(edges: DataFrame) -> DataFrame:
    """(i, j, v): coordinates of the symmetric 0/1 matrix over nodes numbered in their order."""
    e = both_ways(edges)
    ids = indexed_nodes(e.select(F.col("src").alias("node")))
    return e.join(ids.withColumnsRenamed({"node": "src"}), "src").join(ids.withColumnsRenamed({"node": "dst", "i": "j"}), "dst").select("i", "j", F.lit(1).alias("v"))


def bipartite(membership: DataFrame) -> DataFrame:
    """(i, j, v): coordinates of the symmetric matrix of items, numbered first, and members, numbered after them."""
    m = membership.select("item", "member").distinct()
    items, members = indexed_nodes(m, "item"), indexed_nodes(m, "member").withColumnRenamed("i", "j")
    half = m.join(items, "item").join(members, "member").select("i", (F.col("j") + items.count()).alias("j"))
    return half.unionByName(half.select(F.col("j").alias("i"), F.col("i").alias("j"))).withColumn("v", F.lit(1))


def density(edges: DataFrame) -> DataFrame:
    """(nodes, edges, density, dense_bytes): 2 E / n**2, and the bytes of a dense matrix of eight-byte integers."""
    d = degrees(edges).agg(F.count("*").alias("nodes"), F.coalesce(F.sum("degree"), F.lit(0)).alias("s"))
    n = F.col("nodes").cast("double")
    return d.select("nodes", (F.col("s") / 2).cast("long").alias("edges"), F.coalesce(F.col("s") / F.nullif(n * n, F.lit(0.0)), F.lit(0.0)).alias("density"), (8 * F.col("nodes") * F.col("nodes")).alias("dense_bytes"))


def histogram(x: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, low, high, n, percent): equal-width bins from the least to the greatest value, the last one closed."""
    low, high, total = x.agg(F.min(value).cast("double"), F.max(value).cast("double"), F.count(value)).first()
    low, width = low or 0.0, ((high or 0.0) - (low or 0.0)) / bins
    b = F.lit(0) if width == 0 else F.least(F.lit(bins - 1), F.floor((F.col(value) - low) / width).cast("int"))
    y = x.filter(F.col(value).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    return y.select("bin", (F.lit(low) + F.col("bin") * width).alias("low"), (F.lit(low) + (F.col("bin") + 1) * width).alias("high"), "n", (100.0 * F.col("n") / total).alias("percent"))


def box_plot(x: DataFrame, value: str) -> DataFrame:
    """(q1, median, q3, low_whisker, high_whisker, fliers) with exact quartiles and whiskers within 1.5 interquartile ranges.

    Values are ranked by ranges, so no task sorts them all; quartiles are interpolated between two ranks.
    """
    y = numbered(x.select(F.col(value).cast("double").alias("x")).filter("x is not null"), ["x"], "i")
    n = y.count()
    places = [p * (n - 1) for p in (0.25, 0.5, 0.75)]
    wanted = sorted({int(p) + k for p in places for k in (1, 2)})
    at = {r["i"]: r["x"] for r in y.filter(F.col("i").isin(wanted)).collect()}  # six rows at most
    q = [at[int(p) + 1] + (p - int(p)) * (at.get(int(p) + 2, at[int(p) + 1]) - at[int(p) + 1]) for p in places] if n else [0.0] * 3
    inside = F.col("x").between(q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0]))
    return y.groupBy(F.lit(q[0]).alias("q1"), F.lit(q[1]).alias("median"), F.lit(q[2]).alias("q3")).agg(F.min(F.when(inside, F.col("x"))).alias("low_whisker"), F.max(F.when(inside, F.col("x"))).alias("high_whisker"), F.count_if(~inside).alias("fliers"))


def shared_jaccard(edges: DataFrame) -> DataFrame:
    """(a, b, jaccard) of all pairs of nodes that share a neighbour, a < b: counted where two blocks of nodes meet and never shuffled."""
    ship(edges.sparkSession)
    e = checkpoint(both_ways(edges))
    blocks = max(LEAST_BLOCKS, -(-e.count() // BLOCK_ROWS))
    d = e.groupBy("src").agg(F.count("*").alias("d"))
    # each node brings its degree along, and what only one node has is left out: it counts in the degree alone
    known = e.join(d.withColumnRenamed("src", "dst"), "dst").join(d.filter("d > 1").select("src"), "src")
    nodes = F.collect_list(F.struct(F.col("dst").alias("n"), "d")).alias("_nodes")
    rows = known.groupBy(F.col("src").alias("k"), _block("dst", blocks).alias("_a")).agg(nodes)
    return _met(rows, blocks, e.schema["dst"].dataType.simpleString(), "double", False).toDF("a", "b", "jaccard")


def neighbour_jaccard(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, jaccard) of the neighbour sets of pairs, from counts of shared neighbours: no set is gathered.

    Two nodes without neighbours are equal.
    """
    e = both_ways(edges)
    d = e.groupBy("src").agg(F.count("*").alias("d"))
    p = pairs.select("a", "b").distinct()
    shared = p.join(e.select(F.col("src").alias("a"), "dst"), "a").join(e.select(F.col("src").alias("b"), "dst"), ["b", "dst"]).groupBy("a", "b").agg(F.count("*").alias("s"))
    x = p.join(shared, ["a", "b"], "left").join(d.withColumnsRenamed({"src": "a", "d": "da"}), "a", "left").join(d.withColumnsRenamed({"src": "b", "d": "db"}), "b", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    union = zero("da") + zero("db") - zero("s")
    return x.select("a", "b", F.when(union == 0, 1.0).otherwise(zero("s") / union).alias("jaccard"))


def entropy(x: DataFrame, value: str, by: list[str] | None = None, base: float = 2.0) -> DataFrame:
    """Shannon entropy of a column's sample frequencies, for each group."""
    keys = by or []
    counts = x.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    total = counts.groupBy(*keys).agg(F.sum("_n").alias("_t"), F.sum(F.col("_n") * F.log(F.col("_n").cast("double"))).alias("_s"))
    # sum p log p, from counts: log t - sum n log n / t
    return total.select(*keys, ((F.log(F.col("_t").cast("double")) - F.col("_s") / F.col("_t")) / F.log(F.lit(base))).alias("entropy"))


def cross_entropy(distributions: DataFrame) -> DataFrame:
    """(p, q, cross_entropy) in bits for all ordered pairs of named distributions (name, k, prob); infinite where q misses a value of p.

    The pairs are those of a few named distributions; values are joined by key, not crossed.
    """
    d = distributions.select("name", "k", "prob")
    names = d.select("name").distinct()
    pairs = d.withColumnsRenamed({"name": "p"}).filter("prob > 0").join(names.withColumnRenamed("name", "q"))
    x = pairs.join(d.select(F.col("name").alias("q"), "k", F.col("prob").alias("qp")), ["q", "k"], "left")
    term = F.when(F.coalesce("qp", F.lit(0.0)) == 0, F.lit(float("inf"))).otherwise(-F.col("prob") * F.log2("qp"))
    return x.groupBy("p", "q").agg(F.sum(term).alias("cross_entropy"))


def mean_and_spread(x: DataFrame, value: str) -> DataFrame:
    return x.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def seeded_pairs(nodes: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n pairs of nodes, the same for a seed at any partitioning: nodes ordered by a hash, taken two by two."""
    order: Column = F.xxhash64("node", F.lit(seed))
    picked = nodes.select("node").distinct().orderBy(order, "node").limit(2 * n)
    ranked = picked.withColumn("r", F.row_number().over(Window.orderBy(order, "node")) - 1)
    return ranked.groupBy((F.col("r") / 2).cast("int").alias("pair")).agg(F.min_by("node", "r").alias("a"), F.max_by("node", "r").alias("b"))
