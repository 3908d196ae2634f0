import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from catlink.llm.lattice_lm import Pieces, lattice_score, read_pieces, run_lattices  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(word, table):
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in table for rest in all_segmentations(word[n:], table)]


def test_lattice_is_the_sum_over_all_segmentations():
    strings, byte_piece, log = read_pieces(PATH)
    model = Pieces(strings, byte_piece, log)
    table = {s: log[i] for i, s in enumerate(strings) if s}
    texts = [b" the", b" overlapping", b" a", b" " + "é".encode() + b"tat", b" ", b" zzzxq"]
    flat = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    total, expected = run_lattices(flat, offsets, model, np.ones(len(texts)))
    want, counts = [], Counter()
    for t in texts:
        paths = [(sum(table[p] for p in s), s) for s in all_segmentations(t, table)]
        p = sum(math.exp(x) for x, _ in paths)
        want.append(math.log(p))
        for x, s in paths:
            for piece in s:
                counts[piece] += math.exp(x) / p
    assert np.allclose(total, want)
    for i, s in enumerate(strings):
        if s:
            assert abs(expected[i] - counts.get(s, 0)) < 1e-9


def test_scores(spark):
    texts = ["The cat sat", "the cat\tran \x0bfast", None, "", "unseen wörds 日本語 \U0001f600", "x" * 5000, "the the the the", "THE", "THE"]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(100 + i, f"the cat number{i % 5} sat", "z") for i in range(40)] + [(3, "again", None), (None, "cat", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    toks = [[*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")), None] for _, t, _ in rows]
    crc = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 for i, _, _ in rows]
    count = Counter(w for t, f in zip(toks, crc, strict=True) if f != 2 for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), f == 2, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 6)) for (i, _, _), t, f in zip(rows, toks, crc, strict=True))
    scores = []
    for hot in (1000, 3, 0):
        got = lattice_score(df, PATH, hot_words=hot).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        scores.append(sorted((str(r.doc_id), round(r.score, 6)) for r in got))
        assert all(r.score < 0 for r in got)
    assert scores[0] == scores[1] == scores[2]
    assert lattice_score(df.limit(0), PATH).count() == 0


def test_score_by_enumeration(spark):
    """The whole score with the file's prior as weights, every word by all its segmentations."""
    texts = ["the cat sat on the mat", "the dog", "a catalog of dogs", "é the", ""] * 4
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    strings, _, log = read_pieces(PATH)
    table = {s: log[i] for i, s in enumerate(strings) if s}
    toks = [t.split() for t in texts]
    train = [t for i, t in enumerate(toks) if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    total, v = sum(count.values()) + len(train), len(count)
    lattice = lambda w: sum(math.exp(sum(table[p] for p in s)) for s in all_segmentations(b" " + w.encode(), table))
    one = lambda w: math.log10((count[w] + (v + 1) * lattice(w)) / (total + v + 2))
    got = {r.doc_id: r.score for r in lattice_score(df, PATH, rounds=0).collect()}
    for i, t in enumerate(toks):
        assert abs(got[i] - sum(map(one, t)) - math.log10((len(train) + 1) / (total + v + 2))) < 1e-6
