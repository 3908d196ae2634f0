import math
import random

import numpy as np
import pyarrow as pa
import pytest

from catlink.operators import networks as N


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src int, dst int")


@pytest.fixture(scope="module")
def path(spark):
    return edges(spark, [(1, 2), (2, 3), (3, 4), (7, 8)])


def test_traversal(spark, path):
    assert sorted(tuple(r) for r in N.breadth_first(path, 1).collect()) == [(1, 0, None), (2, 1, 1), (3, 2, 2), (4, 3, 3)]
    assert N.breadth_first(path, 1, max_depth=1).count() == 2
    members = spark.createDataFrame([("x", 1), ("x", 2), ("a", 2), ("b", 3), ("a", 3), ("c", 3), ("c", 4)], "item string, member int")
    got = [tuple(r) for r in N.shortest_path(path, members, 1, 4).orderBy("step").collect()]
    assert got == [(0, 1, None), (1, 2, "x"), (2, 3, "a"), (3, 4, "c")]
    assert N.shortest_path(path, None, 1, 8).count() == 0
    assert [tuple(r) for r in N.shortest_path(path, None, 3, 3).collect()] == [(0, 3)]
    assert {r.node: r.depth for r in N.depth_first_tree(path, 7).collect()} == {7: 0, 8: 1}


def test_rank_sums_to_one_and_matches_power_iteration(spark):
    pairs = [(1, 2), (1, 3), (1, 4), (4, 5), (6, 7)]
    got = {r.node: r["rank"] for r in N.page_rank(edges(spark, pairs)).collect()}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    rank = dict.fromkeys(near, 1 / 7)
    for _ in range(200):
        rank = {n: 0.15 / 7 + 0.85 * sum(rank[m] / len(near[m]) for m in near[n]) for n in near}
    assert sum(got.values()) == pytest.approx(1) and all(got[n] == pytest.approx(rank[n], abs=1e-6) for n in rank)


def test_degrees_and_matrices(spark, path):
    assert sum(r.degree for r in N.degrees(path).collect()) == 2 * 4
    assert sorted((r.i, r.j) for r in N.adjacency(path).collect()) == [(0, 1), (1, 0), (1, 2), (2, 1), (2, 3), (3, 2), (4, 5), (5, 4)]
    d = N.density(path).first()
    assert (d.nodes, d.edges, d.dense_bytes) == (6, 4, 288) and d.density == pytest.approx(8 / 36)
    m = spark.createDataFrame([("b", 5), ("a", 5), ("a", 9)], "item string, member int")
    assert sorted((r.i, r.j) for r in N.bipartite(m).collect()) == [(0, 2), (0, 3), (1, 2), (2, 0), (2, 1), (3, 0)]
    assert sorted(tuple(r) for r in N.shared_edges(m, "member", "item").collect()) == [(5, 9, 1)]


def test_jaccard(spark):
    e = edges(spark, [(1, 2), (1, 3), (4, 2), (4, 3), (5, 2)])
    pairs = spark.createDataFrame([(1, 4), (1, 5), (8, 9)], "a int, b int")
    assert {(r.a, r.b): r.jaccard for r in N.neighbour_jaccard(e, pairs).collect()} == {(1, 4): 1.0, (1, 5): 0.5, (8, 9): 1.0}


@pytest.mark.parametrize(("values", "want"), [("aaa", 0.0), ("abc", math.log2(3)), ("abcccccc", -(2 * math.log2(1 / 8) / 8 + 6 / 8 * math.log2(6 / 8)))])
def test_entropy(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert N.entropy(df, "v").first().entropy == pytest.approx(want, abs=1e-12)


def test_cross_entropy(spark):
    d = spark.createDataFrame([("p", "a", 0.5), ("p", "b", 0.5), ("q", "a", 1.0)], "name string, k string, prob double")
    got = {(r.p, r.q): r.cross_entropy for r in N.cross_entropy(d).collect()}
    assert got == {("p", "p"): 1.0, ("p", "q"): math.inf, ("q", "p"): 1.0, ("q", "q"): 0.0}


def test_histogram_and_box(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 100]], "x double")
    bins = {r.bin: r.n for r in N.histogram(df, "x", 10).collect()}
    assert bins == {0: 5, 9: 1}
    b = N.box_plot(df, "x").first()
    assert (b.q1, b.median, b.q3, b.low_whisker, b.high_whisker, b.fliers) == (1.25, 2.5, 3.75, 0.0, 4.0, 1)
    assert N.histogram(df.limit(0), "x", 10).count() == 0


def test_seeded_pairs_do_not_depend_on_partitions(spark):
    nodes = spark.range(50).withColumnRenamed("id", "node")
    one = sorted(tuple(r) for r in N.seeded_pairs(nodes, 5).collect())
    assert one == sorted(tuple(r) for r in N.seeded_pairs(nodes.repartition(7), 5).collect()) and len(one) == 5


def test_shared_edges_shuffle_memberships_not_pairs(spark, monkeypatch):
    from collections import Counter
    from itertools import combinations

    rng = random.Random(4)
    rows = [(rng.randrange(12), rng.choice(["a", "B", "é", "z", "Z9", "", "中", "q", "w", "e1"])) for _ in range(80)] + [(None, "a"), (3, None), (99, "alone")]
    want = Counter()
    for k in range(12):
        want.update(combinations(sorted({n for i, n in rows if i == k and n is not None}), 2))
    m = spark.createDataFrame(rows, "item int, member string")
    monkeypatch.setattr(N, "LEAST_BLOCKS", 1)
    for size in (1000, 30, 7):  # one block to eleven
        monkeypatch.setattr(N, "BLOCK_ROWS", size)
        edges = N.shared_edges(m, "member", "item")
        plan = edges._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
        assert sorted(map(tuple, edges.collect())) == sorted((*p, n) for p, n in want.items())
    both = N.shared_edges(m, "member", "item", symmetric=True).collect()
    assert sorted(map(tuple, both)) == sorted([(*p, n) for p, n in want.items()] + [(*p[::-1], n) for p, n in want.items()])
    assert N.shared_edges(m.limit(0), "member", "item").count() == 0


def test_a_cell_is_counted_in_bounded_steps(monkeypatch):
    import pyarrow as pa

    rows = [(0, k, n) for k in range(4) for n in range(20) if (n + k) % 3]
    table = pa.table({"_side": [r[0] for r in rows], "k": [r[1] for r in rows], "n": [r[2] for r in rows]})
    whole = [b for b in N._count_cell(table, True, False)]
    monkeypatch.setattr(N, "PAIRS", 50)
    steps = [b for b in N._count_cell(table, True, False)]
    assert len(steps) > 5 and pa.Table.from_batches(steps).to_pylist() == pa.Table.from_batches(whole).to_pylist()


def test_jaccard_pairs_are_counted_where_they_meet_and_never_shuffled(spark, monkeypatch):
    from itertools import combinations

    rng = random.Random(5)
    names = [f"n{i}" for i in range(40)] + ["é", "中", "", "Z"]
    # twins around hubs, unlike nodes, a self-loop, a doubled edge and nodes without a name
    pairs = [(n, rng.choice(["h1", "h2", "h3"])) for n in names[:24]] + [(rng.choice(names), rng.choice(names)) for _ in range(50)]
    pairs += [("h1", "h2"), ("n1", "n1"), ("n2", "n3"), ("n3", "n2"), (None, "n4"), ("n5", None)]
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for a, b in combinations(sorted((n for n in near if n is not None), key=str.encode), 2):
        shared = len((near[a] & near[b]) - {None})
        if shared:
            want[a, b] = shared / (len(near[a]) + len(near[b]) - shared)
    e = spark.createDataFrame(pairs, "src string, dst string")
    monkeypatch.setattr(N, "LEAST_BLOCKS", 1)
    for rows, piece, at_once in ((1000, 512, 1 << 20), (30, 3, 40)):  # one block and one step, several of each
        for name, value in (("BLOCK_ROWS", rows), ("PIECE", piece), ("PAIRS", at_once)):
            monkeypatch.setattr(N, name, value)
        found = N.shared_jaccard(e)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("MapInArrow") < plan.index("Aggregate") and plan.index("MapInArrow") < plan.index("Join")
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(want) and {(a, b): v for a, b, v in got} == want
        table = [(0, k, n) for n in sorted(near, key=str) if n is not None for k in near[n] if k is not None]
        table = pa.table({"_side": [r[0] for r in table], "k": [r[1] for r in table], "n": [r[2] for r in table]})
        assert all(sum(len(r["src"]) * len(r["dst"]) for r in b.to_pylist()) <= max(N.PAIRS // 8, len(names) * piece) for b in N._count_cell(table, True, False))


def test_twins_are_told_by_their_items():
    rows = [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 3), (3, 2), (3, 1), (4, 9)]
    nodes, items = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    class_of, members, begin = N._twins(nodes, items, np.array([5, 5, 5, 5, 5]))
    assert class_of[0] == class_of[1] == class_of[3] and len(set(class_of.tolist())) == 3 and begin[-1] == 5
    assert sorted(members[begin[class_of[0]] : begin[class_of[0] + 1]].tolist()) == [0, 1, 3]
    # nodes of different kinds are none
    assert len(set(N._twins(nodes, items, np.array([5, 5, 5, 6, 5]))[0].tolist())) == 4


def test_memberships_are_dealt_in_packs(spark, monkeypatch):
    rows = [(i % 7, i % 50) for i in range(4000)] + [(3, None), (None, 3)]
    m = spark.createDataFrame(rows, "item int, member long").repartition(3)
    monkeypatch.setattr(N, "LEAST_BLOCKS", 2)
    found = N.shared_edges(m, "member", "item")
    assert "_pack" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(a, b, 7) for a in range(50) for b in range(a + 1, 50)]


def test_packs_hold_each_row_once_and_little(monkeypatch):
    import datetime

    monkeypatch.setattr(N, "PACK", 1000)
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(d) for d in range(20)]
    rows = [(a, k, n) for a in (0, 1) for k in days for n in range(a, 1000, 7)]
    table = pa.table({"_a": pa.array([r[0] for r in rows], pa.int64()), "k": [r[1] for r in rows], "n": pa.array([r[2] for r in rows], pa.int64())})
    packs = list(N._pack(iter(table.to_batches(max_chunksize=300))))
    assert len(packs) > 4 and sum(p["_pack"][0].as_buffer().size for p in packs) < 4 * len(rows)
    back = []
    for p in packs:
        held = N._rows_of([p.append_column("_side", pa.array([0], pa.int32()))])
        back += [(p["_a"][0].as_py(), r["k"], r["n"]) for r in held.to_pylist()]
    assert back == rows
    for values in (["b", "é"], [1.5, -0.5], [datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc)] * 2):
        (p,) = N._pack(iter(pa.table({"_a": [5, 5], "k": values, "n": values}).to_batches()))
        assert N._rows_of([p.append_column("_side", pa.array([1], pa.int32()))]).select(["_side", "k", "n"]).to_pylist() == [{"_side": 1, "k": v, "n": v} for v in values]
