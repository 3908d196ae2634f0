import random
import re

import numpy as np
import xxhash

from catlink.llm.simhash import VantageTree, simhash_components


def brute(rows, radius=4):
    prints = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    n = len(rows)
    comp = list(range(n))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return sorted(((k, f"{p:016x}", low.get(find(i))) for i, ((k, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def test_simhash_matches_brute_force(spark):
    random.seed(2)
    vocabulary = ["wörd%d" % i for i in range(60)] + ["THE", "of"]
    rows = []
    for i in range(60):
        w = [random.choice(vocabulary) for _ in range(random.choice([0, 1, 3, 4, 5, 60, 200]))]
        rows.append((i * 7 % 61, " \t".join(w)))
        for _ in range(random.randint(0, 4)):
            x = list(w)
            if x:
                x[random.randrange(len(x))] = "changed"
            rows.append((100 + len(rows), " ".join(x)))
    rows += [(900, None), (901, ""), (902, " \n "), (1, "THE"), (1, "THE"), (None, "the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({}).selectExpr("*", "1 as component_id", "2 as fingerprint")
    for shard_rows in (20_000, 3):
        got = simhash_components(df, shard_rows=shard_rows).collect()
        assert sorted(((r.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in got), key=str) == brute(rows)
    assert simhash_components(df.limit(0)).count() == 0


def test_vantage_tree_is_exact():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 20, dtype=np.uint64)
    values = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for c in centres]))
    tree = VantageTree(values)
    gone = np.arange(0, len(values), 3)
    tree.leave(gone)
    for v in values[::7]:
        want = np.flatnonzero((np.bitwise_count(values ^ v) <= 4) & tree.alive)
        assert sorted(tree.within(v, 4).tolist()) == want.tolist()


def test_linked_matches_brute_force():
    from catlink.llm.simhash import linked

    rng = np.random.default_rng(6)
    values = np.unique(np.concatenate([rng.integers(0, 2**63, 500, dtype=np.uint64), np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 63, 40, dtype=np.uint64))]))
    for radius in (0, 2, 7, 20):
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
        np.fill_diagonal(near, False)
        assert (linked(values, radius) == near.any(axis=1)).all()


def test_near_duplicates_are_verified(spark):
    from catlink.llm.simhash import drop_near_duplicates

    random.seed(31)
    words = ["".join(random.choices("abcdefghijklmnop", k=random.randint(3, 9))) for _ in range(2000)]
    docs = {}
    for i in range(60):
        base = random.choices(words, k=200)
        for j, edits in enumerate((0, 1, 3, 8, 10)):  # scattered; five-word similarity 1, 0.95, 0.86, 0.67, 0.6
            w = list(base)
            for k in range(edits):
                w[5 + k * (190 // max(edits, 1))] = f"edited{j}x{k}"
            docs[10 * i + j] = " ".join(w)
        docs[10 * i + 5] = "  ".join(base).upper()
        docs[10 * i + 6] = " ".join(base[:180] + random.choices(words, k=20))  # 0.81, in one place
    docs |= {9000: "", 9001: None, 9002: " "}
    shingles = {d: {tuple((t or "").lower().split()[i : i + 5]) for i in range(max(1, len((t or "").split()) - 4))} for d, t in docs.items()}
    alike = lambda a, b: len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b]) >= 0.8
    kept = {r.doc_id for r in drop_near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    for d in docs.keys() - kept:
        assert any(alike(d, k) for k in kept if k < d)
    close = [(a, b) for a in kept for b in range(a + 1, a + 10) if b in kept and alike(a, b)]
    assert len(close) <= 6 and len([d for d in kept if d % 10 in (3, 4) and d < 9000]) == 120
    assert kept >= {10 * i for i in range(60)} and kept & {9000, 9001, 9002} == {9000}


def test_unlike_texts_with_close_fingerprints_are_not_linked(spark, monkeypatch):
    from catlink.llm import simhash

    random.seed(8)
    word = lambda: "".join(random.choices("abcdefghij", k=8))
    docs = [(i, "over and " * 60 + " ".join(word() for _ in range(24))) for i in range(200)]
    docs += [(1000 + i, t + " end") for i, t in docs[:5]]
    links, find = [], simhash.connected_components
    monkeypatch.setattr(simhash, "connected_components", lambda edges: links.append(edges.distinct().count()) or find(edges))
    kept = {r.doc_id for r in simhash.drop_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == set(range(200)) and links[0] <= 10  # 200 and more when a close fingerprint is enough
