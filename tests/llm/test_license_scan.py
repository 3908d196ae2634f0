import random
import re

from catlink.llm.license_scan import TEMPLATES, license_scan


def words(text):
    return re.sub(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", " ", text.lower()).split()


def brute(rows, containment=0.8):
    shingles = lambda w: [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
    best = {}
    for d, t in rows:
        h = shingles(words(t or ""))
        for name, notice in TEMPLATES.items():
            name = name.split("/")[0]
            own = set(shingles(words(notice)))
            s = len(own)
            for at in range(0, len(h), s):
                share = len(own & set(h[at : at + 2 * s])) / s
                if share >= containment and (share, -at) > best.get((d, name), (0, 0)):
                    best[d, name] = (share, -at)
    return sorted(((*k, v[0], -v[1]) for k, v in best.items()), key=str)


def test_matches_brute_force(spark):
    random.seed(3)
    filler = ["licensed", "under", "the", "MIT", "license", "released", "work", "être", "x9"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(120):
        w = random.choices(filler, k=random.choice([0, 2, 4, 5, 20, 300]))
        for name in random.sample(sorted(TEMPLATES), random.randrange(3)):
            notice = TEMPLATES[name].split()
            if random.random() < 0.4:
                notice[random.choice([0, -1])] = "other"
            at = random.randrange(len(w) + 1)
            w[at:at] = [random.choice([x, x.upper(), x + ","]) for x in notice]
        rows.append((i, random.choice([" ", "\n", " - "]).join(w)))
    rows += [(1000, None), (1001, ""), (1002, "MIT"), (5, rows[5][1]), (None, "x Released under the MIT License. y")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, license string")
    got = sorted(((r.doc_id, r.license, r.containment, r.first_word) for r in license_scan(df).collect()), key=str)
    assert len(got) > 60 and got == brute(rows)
    assert license_scan(df.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    df = spark.range(3).selectExpr("id as doc_id", "'x' as text")
    plan = license_scan(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan)


def test_many_long_templates_plan(spark):
    random.seed(8)
    texts = {f"L{i}": " ".join(f"w{random.randrange(500)}" for _ in range(200 + i % 3)) for i in range(300)}
    df = spark.createDataFrame([(1, "start " + texts["L7"] + " end"), (2, texts["L8"][: len(texts["L8"]) // 2]), (3, "x " * 100_000 + texts["L299"])], "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in license_scan(df, texts).collect()} == {(1, "L7"), (3, "L299")}


def test_whole_license_texts(spark):
    body = TEMPLATES["MIT/text"].lower().replace(",", " ,")
    gnu = "This program is free software; you can redistribute it and/or modify it {} (at your option) any later version."
    rows = [(1, f"Copyright (c) 2001 A. Person\n\n{body}\n"), (2, body[:300])] + [(3 + i, gnu.format(TEMPLATES[f"{k}/notice"])) for i, k in enumerate(["GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in license_scan(df).collect()} == {(1, "MIT"), (3, "GPL-2.0"), (4, "GPL-3.0"), (5, "LGPL-2.1"), (6, "LGPL-3.0"), (7, "AGPL-3.0")}
