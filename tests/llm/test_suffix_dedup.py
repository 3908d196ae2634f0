import random
from collections import defaultdict

import pytest

from catlink.llm import suffix_dedup as module
from catlink.llm.suffix_dedup import suffix_dedup


def brute(rows, length, keep):
    seen = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]].append((i, p, n))
    out = []
    for n, (i, t) in enumerate(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = seen[b[p : p + length]]
            if len(s) > 1 if keep == "none" else min(s) < (i, p, n):
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def corpus():
    random.seed(11)
    word = lambda: "".join(random.choices("abcdé", k=random.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    common = text(60)
    rows = []
    for i in range(60):
        t = text(random.choice([0, 3, 40, 120]))
        for _ in range(random.randint(0, 2)):
            a, b = sorted(random.sample(range(len(common)), 2))
            t = t[: len(t) // 2] + common[a:b] + t[len(t) // 2 :]
        rows.append((i * 7 % 61, t))
        if random.random() < 0.2:
            rows.append((100 + i, t[: len(t) // 2] + "#" + t[len(t) // 2 :]))
        if random.random() < 0.1:
            rows.append((200 + i, t))
    rows += [(300 + i, "abcde " * random.randint(10, 60)) for i in range(6)] + [(400, None), (401, ""), (402, "é" * 300), (403, "é" * 200)]
    return rows


@pytest.mark.parametrize(("length", "keep"), [(64, "none"), (64, "first"), (40, "none"), (40, "first"), (200, "none"), (200, "first")])
def test_matches_brute_force(spark, monkeypatch, length, keep):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup(df, min_bytes=length, keep=keep).collect()), key=str)
    assert got == brute(rows, length, keep)


def test_odd_rows(spark):
    long = "0123456789" * 3 + "abcdefghij" * 3
    rows = [(1, long), (1, long), (None, long + "x"), (2, "q" + long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup(df, min_bytes=60).collect()] == [60] * 4
    # a null id is the earliest; rows with equal id and text are one document
    got = sorted(((r.doc_id or 0, r.n_removed) for r in suffix_dedup(df, min_bytes=60, keep="first").collect()))
    assert got == [(0, 0), (1, 60), (1, 60), (2, 60)]
    assert suffix_dedup(df.limit(0)).count() == 0
    carried = suffix_dedup(df, min_bytes=60, carry=("doc_id", "text")).filter("doc_id = 2").first()
    assert carried.carried.text == "q" + long and bytes(carried.kept) == b"q"


def test_whole_characters(spark):
    a = "xé" * 40
    rows = [(1, a), (2, "é" + a[1:])]
    got = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_bytes=51, whole_chars=True).collect()}
    assert set(got) == {1, 2}


def test_small_shards_change_nothing(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    rows = corpus()
    texts = pa.array([t or "" for _, t in rows])
    ids = pa.array([i for i, _ in rows])
    key = pa.array(np.arange(len(rows)))
    batch = pa.RecordBatch.from_arrays([key, ids, texts], names=["_r", "_i", "_t"])
    (found,) = list(module._count_stretches(64)(iter([batch])))
    assert found.num_rows > 0 and set(found.schema.names) == {"_r", "_i", "_k", "_d", "_c"}


@pytest.mark.parametrize("bits", [28, 13])
def test_two_rules_at_once(spark, monkeypatch, bits):
    """Also with a bitmap so small that most anchors pass it."""
    monkeypatch.setattr(module, "FILTER_BITS", bits)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup(df, min_bytes=200, keep="none", also=(64, "first", False)).collect()
    by = lambda j: sorted(((r.doc_id, r.n_bytes, r[f"n_removed{j}"], r[f"n_spans{j}"], bytes(r[f"kept{j}"])) for r in got), key=str)
    assert by("") == brute(rows, 200, "none") and by("1") == brute(rows, 64, "first")


def test_anchors_that_occur_once_are_left_out(spark):
    import types

    import numpy as np
    import pyarrow as pa

    random.seed(5)
    text = lambda: "".join(random.choices("abcdefgh ", k=3000))
    shared = text()
    texts = [text() + shared, shared, *(text() for _ in range(20))]
    bitmap = module._repeated_anchors(spark.createDataFrame([(t,) for t in texts], "_t string"), 240)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(np.arange(len(texts))), pa.array(texts)], names=["_r", "_i", "_t"])
    rows = lambda **k: pa.Table.from_batches(module._count_stretches(240, **k)(iter([batch])))
    every, some = rows(), rows(repeated=types.SimpleNamespace(value=bitmap))
    twice = lambda t: {k for k, n in t.group_by("_k").aggregate([("_c", "sum")]).to_pandas().values.tolist() if n >= 2}
    assert twice(every) and twice(every) == twice(some) and some.num_rows < every.num_rows / 2
