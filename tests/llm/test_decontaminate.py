import pickle
import random
from collections import Counter

import numpy as np

from catlink.llm import decontaminate
from catlink.llm.decontaminate import SLACK, BlockMaxIndex, contaminated, overlap, question_answer, shingles, split_words


def brute(docs, items, width, n=5, similarity=0.8):
    out = set()
    for d, t in docs:
        w = split_words(t or "")
        for at in range(0, max(1, len(w)), width):
            for i, x in items:
                if i is None or not x or not split_words(x):
                    continue
                q, a = question_answer(x)
                more = max(0, len(q) + len(a) - width)
                part = w[max(0, at - more) : at + 2 * width + more]
                have = shingles(part, n)
                if part and overlap(q, have, part, n) >= similarity and overlap(a, have, part, n) >= similarity:
                    out.add((d, i))
    return out


def test_matches_brute_force(spark, monkeypatch):
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "a"] * 30
    sentence = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, ". ".join(sentence(random.randint(4, 14)) for _ in range(random.randint(1, 4))) + ".") for i in range(60)]
    items += [(100, items[0][1]), (101, None), (102, "  "), (None, "x y z"), (103, "one two"), (104, "rep rep rep rep rep rep rep rep. rep rep")]
    docs = []
    for d in range(150):
        body = sentence(random.randint(0, 160)).split(" ")
        for _ in range(random.randint(0, 2)):
            w = items[random.randrange(60)][1].split(" ")
            for _ in range(random.randint(0, 3)):
                w[random.randrange(len(w))] = "Changed"
            at = random.randrange(len(body) + 1)
            body[at:at] = [x.upper() for x in w]
        docs.append((d, random.choice([" ", "\n", " \t"]).join(body)))
    docs += [(500, None), (501, ""), (502, "one two"), (503, "rep " * 30), (None, items[3][1]), (4, items[4][1])]
    frame = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    width = max(len(split_words(t)) for _, t in items if t)
    want = brute(docs, items, width)
    assert len(want) > 30
    assert {(r.doc_id, r.item_id) for r in contaminated(frame, bench).collect()} == want
    monkeypatch.setattr(decontaminate, "SHARD_SEGMENTS", 7)
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 20)
    found = {(r.doc_id, r.item_id) for r in contaminated(frame, bench).collect()}
    assert found >= {(d, i) for d, i in want if dict(docs)[d] and dict(items)[i].lower() in dict(docs)[d].lower()}
    assert contaminated(frame.limit(0), bench).count() == 0 and contaminated(frame, bench.limit(0)).count() == 0


def test_passages_that_touch_other_text(spark):
    short, long = "What is the name of the river there? It is Oka.", "one two three four five six seven eight. Ten lovely small words end this item of the list."
    bench = spark.createDataFrame([(1, short), (2, long), (3, "ÉTÉ à la mer. Où ça")], "item_id long, text string")
    texts = [f"he said “{x}” and left" for x in (short, long)] + [f"see ({x[:-1]})&&&more" for x in (short, long)] + [f"so:{x}Next" for x in (short, long)]
    texts += [f"«{short.upper()}»", "l'été à la mer. où ça!!", short.replace("Oka", "Don"), "what is the name of the river there"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {(0, 1), (1, 2), (2, 1), (3, 2), (4, 1), (5, 2), (6, 1), (7, 3)}
    assert {(r.doc_id, r.item_id) for r in contaminated(frame, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.drop_contaminated(frame, bench).collect()} == {8, 9}


def build(texts):
    split = [split_words(t) for t in texts]
    frequency = Counter(w for x in split for w in set(x))
    return BlockMaxIndex([(i, t, {w: frequency[w] for w in set(x)}) for i, (t, x) in enumerate(zip(texts, split, strict=True))], len(texts), sum(map(len, split)) / len(texts), max(map(len, split)), 5, 0.8)


def test_wand_retrieves_all_segments_at_the_threshold():
    random.seed(3)
    vocabulary = [f"w{int(random.paretovariate(0.7))}" for _ in range(4000)]
    index = build([" ".join(random.choices(vocabulary, k=random.randint(2, 60))) for _ in range(400)])
    dense = np.zeros((len(index.mark), len(index.item)))
    for t in range(len(index.mark)):
        at = slice(index.start[t], index.start[t + 1])
        dense[t, index.segment[at]] = index.weight[at]
    all_blocks, hits = np.arange(index.blocks), 0
    for _ in range(300):
        terms = np.unique(np.random.default_rng(random.randrange(10**6)).integers(0, len(index.mark), random.randint(1, 80)))
        if random.random() < 0.5:  # words of an item among them
            j = random.randrange(len(index.item))
            terms = np.union1d(terms, np.flatnonzero(dense[:, j])[: random.randint(1, 60)])
        want = dense[terms].sum(axis=0)
        found = dict(index.wand(terms, all_blocks))
        assert set(found) == set(np.flatnonzero(want >= 1 - SLACK).tolist())
        assert all(abs(want[j] - score) < 1e-9 for j, score in found.items())
        opened = np.unique(np.flatnonzero(want >= 1 - SLACK) // decontaminate.BLOCK_SEGMENTS)
        assert dict(index.wand(terms, opened)) == found
        hits += len(found)
    assert hits > 200


def test_the_index_is_sparse_and_takes_long_items(spark):
    random.seed(4)
    words = [f"word{i}" for i in range(59_000)]
    index = build([" ".join(random.choices(words, k=120)) for _ in range(2048)])
    assert len(pickle.dumps(index)) < 20_000_000
    long = " ".join(random.choices(words, k=40_000)) + ". The answer stands here at the end."
    bench = spark.createDataFrame([(1, long), (2, "A short one. It is here too.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " * 50 + long + " y" * 900), (2, long[: len(long) // 2]), (3, "a short one it is here too"), (4, "z " * 200_000)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == {(1, 1), (3, 2)}
