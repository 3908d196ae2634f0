import numpy as np

from catlink.llm.cover_tree import CoverTree, Links, cosine_links, dual_traversal


def brute(rows, cosine=0.98):
    n = len(rows)
    unit = []
    for _, v, lab in rows:
        ok = lab is not None and v is not None and len(v) and all(e is not None and np.isfinite(e) for e in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    comp = [None] * n
    for i in range(n):
        if comp[i] is None:
            seen, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            ids = [rows[k][0] for k in seen if rows[k][0] is not None]
            for k in seen:
                comp[k] = min(ids) if ids else None
    return sorted(((r[0], len(x), c, r[0] == c) for r, x, c in zip(rows, links, comp, strict=True)), key=str)


def sample(rng, n, dims=8, spread=0.08):
    centres = rng.normal(size=(max(2, n // 12), dims))
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dims)) * spread * rng.integers(0, 3, (n, 1))).astype(np.float32)


def test_links_match_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i * 3 % 701, v.tolist(), int(rng.integers(0, 3))) for i, v in enumerate(sample(rng, 260))]
    rows += [(1000, None, 1), (1001, [0.0] * 8, 1), (1002, [1.0, None] + [0.0] * 6, 1), (1003, [float("nan")] * 8, 1), (1004, rows[0][1], None), (1005, [1.0, 0.0], 1), (1006, [2.0, 0.0], 1), (1007, [float("inf")] * 8, 0), (1008, [], 0)]
    rows += [(1010, rows[0][1], rows[0][2]), (1011, rows[0][1], rows[0][2]), (None, rows[1][1], rows[1][2]), (1012, [3 * e for e in rows[2][1]], rows[2][2]), (1010, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, label int, c int")
    for cell_rows, pivots in ((4096, 64), (16, 4), (9, 64)):
        got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cosine_links(df, cell_rows=cell_rows, pivots=pivots).collect()), key=str)
        assert got == brute(rows)
    assert cosine_links(df.limit(0)).count() == 0


def test_dual_traversal_counts():
    rng = np.random.default_rng(8)
    for spread in (0.0, 0.01, 0.1, 1.0):
        x = sample(rng, 300, 6, spread).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        weight = rng.integers(1, 5, 300)
        want = (x @ x.T >= 0.98) @ weight
        tree, links = CoverTree(x, 0.02), Links(300)
        dual_traversal(tree, tree, 0, 0.98, weight, links)
        assert (links.count == want).all()
        one, two, links = CoverTree(x[:120], 0.02), CoverTree(x[120:], 0.02), Links(300)
        dual_traversal(one, two, 120, 0.98, weight, links)
        m = x[:120] @ x[120:].T >= 0.98
        assert (links.count == np.concatenate([m @ weight[120:], weight[:120] @ m])).all()
