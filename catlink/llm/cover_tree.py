"""Embedding near-duplicates: exact cosine threshold pairs by cover-tree dual traversal (operator 8).

Vectors are compared only when their labels are equal and not null.  They are unit vectors under
Euclidean distance, so cosine >= threshold is distance <= sqrt(2 - 2 threshold).

* Equal vectors of a label collapse to one class with a count first (a partial aggregate); a class with
  very many vectors, and the root of a large component, are looked up in a bounded broadcast.
* A large label is dealt into cells around pivots, and a cell of more than ``cell_rows`` classes
  into further units, so no task holds more than two units.  Pairs of units are pruned by pivot
  distance and covering radii; the remaining ones are the tasks.
* In a task each unit has a cover tree: nested levels whose radii halve, every parent a member of
  its own children.  The dual traversal takes pairs of nodes, drops those whose centres are
  farther apart than both covering radii and the threshold, takes those whose members must all be
  close as a whole, and opens the others; single vectors are decided by their cosine.
* No pair is emitted: a task returns each class's number of close vectors and edges that connect
  the close ones, at most one for each class and opened pair of nodes.

Vectors that no bound tells apart (unrelated ones in many dimensions are all about as far from
each other) are compared in blocks: within a label, work then grows with the square of its classes,
spread over pairs of units.

Cases: ids and labels are integers, or text that reads as one; a null label, a null or zero vector, and one with null or non-finite components link with
nothing and are kept; vectors of different lengths never link; repeated rows are vectors of their
own, linked with each other; an empty table gives an empty result; other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, lookup, ship
from catlink.operators.components import connected_components

CELL_ROWS = 4096
PIVOTS = 64
LEAF = 8
SLACK = 1e-9


class CoverTree:
    """Nodes over unit vectors: centre, covering radius, members, and children unless a single vector."""

    def __init__(self, x: np.ndarray, least: float):
        self.x, self.least = x, least
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.members: list[np.ndarray] = []
        self.children: list[np.ndarray | None] = []
        if len(x):
            self._node(np.arange(len(x)), 2.0)

    def _far(self, rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (self.x[rows] @ self.x[centre])))

    def _node(self, rows: np.ndarray, radius: float) -> int:
        me = len(self.centre)
        far = self._far(rows, rows[0])
        self.centre.append(int(rows[0]))
        self.radius.append(float(far.max()) if len(rows) > 1 else 0.0)
        self.members.append(rows)
        self.children.append(None)
        if len(rows) == 1:
            return me
        inner = radius / 2.0
        while inner >= self.radius[me] and inner > self.least:  # levels that would hold one node
            inner /= 2.0
        made = []
        if len(rows) <= LEAF or inner <= self.least:
            made = [self._node(rows[i : i + 1], 0.0) for i in range(len(rows))]
        else:
            left = rows
            while len(left):
                near = self._far(left, left[0]) <= inner
                near[0] = True
                made.append(self._node(left[near], inner))
                left = left[~near]
        self.children[me] = np.array(made)
        return me


class Links:
    """Counts of close vectors, and edges that connect them."""

    def __init__(self, size: int):
        self.count = np.zeros(size, np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def whole(self, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> None:
        """All of a are close to all of b; disjoint, or the same set."""
        self.count[a] += weight[b].sum()
        if a[0] != b[0]:
            self.count[b] += weight[a].sum()
        both = np.concatenate([a, b])
        self.edges.append((both, np.full(len(both), both.min())))

    def block(self, a: np.ndarray, b: np.ndarray, close: np.ndarray, weight: np.ndarray, same: bool) -> None:
        self.count[a] += close @ weight[b]
        if not same:
            self.count[b] += weight[a] @ close
        rows, columns = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
        close, row, column = close[np.ix_(rows, columns)], a[rows], b[columns]
        # smallest label of a neighbour, until nothing changes
        low_row, low_column, top = row.copy(), column.copy(), np.int64(2**62)
        while True:
            new_row = np.minimum(low_row, np.where(close, low_column[None, :], top).min(axis=1))
            new_column = np.minimum(low_column, np.where(close, new_row[:, None], top).min(axis=0))
            if (new_row == low_row).all() and (new_column == low_column).all():
                break
            low_row, low_column = new_row, new_column
        self.edges.append((np.concatenate([row, column]), np.concatenate([low_row, low_column])))


def dual_traversal(one: CoverTree, two: CoverTree, shift: int, cosine: float, weight: np.ndarray, links: Links) -> None:
    """All close pairs between two trees, or within one (``two is one``).

    Members of the second tree are numbered from ``shift``; ``weight`` is by that numbering.
    """
    if not len(one.x) or not len(two.x):
        return
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    todo = [(0, 0)]
    while todo:
        p, q = todo.pop()
        same = two is one and p == q
        a = one.children[p] if one.children[p] is not None else np.array([p])
        b = a if same else two.children[q] if two.children[q] is not None else np.array([q])
        ca, cb = np.array([one.centre[i] for i in a]), np.array([two.centre[i] for i in b])
        ra, rb = np.array([one.radius[i] for i in a]), np.array([two.radius[i] for i in b])
        step = max(1, (1 << 21) // len(b))
        for at in range(0, len(a), step):
            part = slice(at, at + step)
            dots = one.x[ca[part]] @ two.x[cb].T
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))
            span = ra[part, None] + rb[None, :]
            near = far <= reach + span + SLACK
            single = (ra[part, None] == 0.0) & (rb[None, :] == 0.0) & np.array([len(one.members[i]) == 1 for i in a[part]])[:, None] & np.array([len(two.members[i]) == 1 for i in b])[None, :]
            close = single & (dots >= cosine)
            if close.any():
                links.block(ca[part], cb + shift, close, weight, same)
            for i, j in zip(*np.nonzero(near & ~single), strict=True):
                if same and a[at + i] > b[j]:
                    continue
                x, y = a[at + i], b[j]
                own = two is one and x == y
                # within one node, members are at most two radii apart
                most = 2.0 * ra[at + i] if own else far[i, j] + span[i, j]
                if most <= reach - SLACK:
                    links.whole(one.members[x], two.members[y] + shift, weight)
                else:
                    todo.append((x, y))


def _units(pivots):
    """Deals a label's classes to the cells of their nearest pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pivots.value
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            cell, far = np.zeros(len(label), np.int32), np.full(len(label), 2.0)
            for v in np.unique(label):
                if (p := table.get(int(v))) is None:
                    continue
                rows = np.flatnonzero(label == v)
                x = _unit_rows(batch.column("v").take(pa.array(rows)))
                fits = np.flatnonzero([len(r) == p.shape[1] for r in x])
                if len(fits):
                    d = np.stack([x[i] for i in fits]) @ p.T
                    best = d.argmax(axis=1)
                    cell[rows[fits]] = best
                    far[rows[fits]] = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * d[np.arange(len(fits)), best]))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("c", "label", "m")], pa.array(cell), pa.array(far), batch.column("v")], names=["c", "label", "m", "cell", "far", "v"])

    return run


def _unit_rows(column) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(column)))])
    out = []
    for i in range(len(ends) - 1):
        v = flat[ends[i] : ends[i + 1]]
        v = v / np.abs(v).max()
        out.append(v / np.sqrt(v @ v))
    return out


def _tasks(cosine: float):
    """Streams a partition sorted by task and side; holds one task at a time."""

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        table = pa.Table.from_batches(held).combine_chunks()
        side = table["side"].to_numpy()
        c, m = table["c"].to_numpy(), table["m"].to_numpy()
        x = _unit_rows(table["v"].combine_chunks() if table["v"].num_chunks != 1 else table["v"].chunk(0))
        links = Links(len(c))
        both = bool((side == 1).any())
        for size in sorted({len(v) for v in x}):
            fits = np.array([len(v) == size for v in x])
            first, second = np.flatnonzero(fits & (side == 0)), np.flatnonzero(fits & (side == 1))
            order = np.concatenate([first, second])
            inner, weight = Links(len(order)), m[order]
            least = float(np.sqrt(2.0 - 2.0 * cosine)) / 8.0
            one = CoverTree(np.stack([x[i] for i in first]) if len(first) else np.zeros((0, size)), least)
            two = CoverTree(np.stack([x[i] for i in second]), least) if len(second) else one
            if not both or len(second):
                dual_traversal(one, two, len(first) if both else 0, cosine, weight, inner)
            links.count[order] += inner.count
            links.edges += [(order[a], order[b]) for a, b in inner.edges]
        a = np.concatenate([np.zeros(0, np.int64), *[e[0] for e in links.edges]])
        b = np.concatenate([np.zeros(0, np.int64), *[e[1] for e in links.edges]])
        pair = np.unique(np.stack([a, b]), axis=1)
        pair = pair[:, pair[0] != pair[1]]
        some = np.flatnonzero(links.count)
        if not len(some):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([c[some], c[pair[0]]])), pa.array(np.concatenate([links.count[some], np.zeros(pair.shape[1], np.int64)])), pa.array(np.concatenate([c[some], c[pair[1]]]))], names=["c", "n", "other"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            task = batch.column("task").to_numpy(zero_copy_only=False)
            if len(task) == 0:
                continue
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if task[a] != last:
                    if held and (out := close(held)) is not None:
                        yield out
                    held, last = [], task[a]
                held.append(batch.slice(a, b - a))
        if held and (out := close(held)) is not None:
            yield out

    return run


def cosine_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, cosine: float = 0.98, cell_rows: int = CELL_ROWS, pivots: int = PIVOTS) -> DataFrame:
    """Returns (id, n_links, component_id, kept), one row for each input row."""
    spark = vectors.sparkSession
    ship(spark)
    v = F.col("v")
    own = vectors.select(F.col(id_col).cast("long").alias("_i"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(v, lambda e: e != 0)
    fit = F.coalesce(F.col("label").isNotNull() & v.isNotNull() & finite, F.lit(False))
    rows = checkpoint(own.select("_i", "label", F.when(fit, F.transform(v, lambda e: e + 0.0)).alias("v")))
    kinds = checkpoint(rows.filter("v is not null").groupBy("label", "v").agg(F.count("*").alias("m"), F.min("_i").alias("least")))
    classes, seed = None, 0
    while classes is None:  # a class is numbered by a hash of its vector; a hash that two vectors share asks for another seed
        number = F.xxhash64("label", "v", F.lit(seed))
        made = kinds.withColumn("c", number)
        size = made.agg(F.count("*").alias("kinds"), F.count_distinct("c").alias("ids"), F.coalesce(F.sum("m"), F.lit(0)).alias("rows")).first()
        classes, seed = (made if size["kinds"] == size["ids"] else None), seed + 1
    large = classes.groupBy("label").agg(F.count("*").alias("_n")).filter(F.col("_n") > cell_rows)  # a row for each cell_rows classes at most
    # pivots: the classes of smallest hash, of about four times as many drawn by it in one pass
    share = F.least(F.lit(pivots), F.ceil(F.col("_n") / cell_rows)) * 4 / F.col("_n")
    drawn = classes.join(F.broadcast(large), "label").withColumn("_p", F.pmod(F.xxhash64("c", F.lit(11)), F.lit(1 << 30))).filter(F.col("_p") < share * (1 << 30))
    table: dict[int, np.ndarray] = {}
    for r in drawn.groupBy("label").agg(F.min("_n").alias("n"), F.array_sort(F.collect_list(F.struct("_p", "c", "v"))).alias("x")).toLocalIterator():
        chosen = [np.array(x["v"]) for x in r["x"] if len(x["v"]) == len(r["x"][0]["v"])][: min(pivots, -(-r["n"] // cell_rows))]
        chosen = [x / np.abs(x).max() for x in chosen]
        table[r["label"]] = np.stack([x / np.sqrt(x @ x) for x in chosen])
    dealt = classes.select("c", "label", "m", "v").mapInArrow(_units(spark.sparkContext.broadcast(table)), "c long, label long, m long, cell int, far double, v array<double>")
    dealt = checkpoint(dealt)
    cells = dealt.groupBy("label", "cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / cell_rows).cast("int"))
    units = cells.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("label", "cell", "parts", "part", "radius")

    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    gaps = [(int(k), i, j, float(np.sqrt(max(0.0, 2.0 - 2.0 * float(p[i] @ p[j]))))) for k, p in table.items() for i in range(len(p)) for j in range(len(p))]
    gap = spark.createDataFrame(gaps, "label long, cell int, cell2 int, gap double")
    other = units.select("label", F.col("cell").alias("cell2"), F.col("part").alias("part2"), F.col("radius").alias("radius2"))
    # units, not vectors: a row for each cell_rows classes of a label
    pairs = units.join(other, "label").filter("cell < cell2 or (cell = cell2 and part <= part2)").join(gap, ["label", "cell", "cell2"], "left")
    pairs = pairs.filter(F.coalesce(F.col("gap"), F.lit(0.0)) <= F.col("radius") + F.col("radius2") + reach + SLACK)
    task = F.xxhash64("label", "cell", "part", "cell2", "part2")
    sides = pairs.select("label", "cell", "part", task.alias("task"), F.lit(0).alias("side")).unionByName(
        pairs.filter("cell <> cell2 or part <> part2").select("label", F.col("cell2").alias("cell"), F.col("part2").alias("part"), task.alias("task"), F.lit(1).alias("side"))
    )
    placed = lookup(dealt, cells.select("label", "cell", "parts", F.col("n").alias("_n")), ["label", "cell"], size["kinds"]).withColumn("part", F.pmod(F.xxhash64("c", F.lit(7)), F.col("parts")).cast("int"))
    sent = placed.join(sides, ["label", "cell", "part"]).select("task", "side", "c", "m", "v").repartition("task").sortWithinPartitions("task", "side", "c")
    found = checkpoint(sent.mapInArrow(_tasks(cosine), "c long, n long, other long"))
    counts = found.groupBy("c").agg(F.sum("n").alias("n"))
    nodes = connected_components(found.filter("c <> other").select(F.col("c").alias("src"), F.col("other").alias("dst"))).withColumnsRenamed({"node": "c", "component": "root"})
    grouped = checkpoint(classes.select("c", "least").join(nodes, "c", "left").withColumn("root", F.coalesce("root", "c")))
    roots = grouped.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("_n"))
    named = lookup(grouped, roots, "root", size["kinds"]).join(counts, "c", "left").select("c", "component", "n")
    numbered = rows.filter("v is not null").select("_i", number.alias("c"))
    held = classes.select("c", F.col("m").alias("_n")).join(named, "c")
    linked = lookup(numbered, held, "c", size["rows"]).select("_i", (F.coalesce("n", F.lit(1)) - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.filter("v is null").select("_i", F.lit(0).cast("long").alias("n_links"), F.col("_i").alias("component_id"))
    both = linked.unionByName(alone)
    return both.select(F.col("_i").alias(id_col), "n_links", "component_id", F.coalesce(F.col("_i") == F.col("component_id"), F.col("_i").isNull() & F.col("component_id").isNull()).alias("kept"))
