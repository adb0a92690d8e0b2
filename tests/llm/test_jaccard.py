"""Near copies against all pairs in plain Python."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F
from revrecon.llm import jaccard_join
from revrecon.llm.components import components, local_roots
from revrecon.llm.jaccard_join import bucket_links, near_copies, without_near_copies
from revrecon.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def grams(text):
    w = (text or "").split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def brute(rows):
    sets = [grams(t) for _, t in rows]
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    linked = defaultdict(set)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in by[g]:
                common[j] += 1
        for j, c in common.items():
            if j != i and 10 * c >= 8 * (len(s) + len(sets[j]) - c):
                linked[i].add(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(linked[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in df.collect()), key=repr)


def test_query_on_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(REGISTRY["op10_jaccard_join"](spark, SF)) == brute(rows)


def test_groups_of_all_kinds(make_docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(30)]
    for i in range(30, 180):
        near = list(base)
        for _ in range(rng.randint(1, 4)):
            near[rng.randrange(120)] = word()
        rows.append((i, " ".join(near)))
    passage = " ".join(word() for _ in range(60))
    rows += [(i, f"{passage} " + " ".join(word() for _ in range(40))) for i in range(200, 300)]
    rows += [(500, "a b"), (501, "a  b"), (502, "a"), (503, None), (504, ""), (505, " \n"), (None, "a b"), (None, None), (500, "a b")]
    rows += [(600, "long " * 20_000), (601, "long " * 3)]
    rng.shuffle(rows)
    docs = make_docs(rows)
    assert found(near_copies(docs)) == brute(rows)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    classes = {c for d, n, c in brute(rows)}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(c for c in classes if c is not None)
    assert got.count(None) == 1


def test_columns_that_clash_with_own_ones(make_docs):
    docs = make_docs([(3, "one two three four five six"), (1, "one two three four five six"), (1, "one two three four five six"), (None, None), (4, ""), (4, "")])
    for c in ("_key", "_content", "_all", "key", "content", "all", "doc", "root", "set_id", "class_id", "n_links", "signature", "copies"):
        docs = docs.withColumn(c, F.col("doc_id") + 1)
    kept = without_near_copies(docs)
    assert kept.schema == docs.schema
    assert sorted((r["doc_id"] or 0, r["_key"], r["all"]) for r in kept.collect() if r["doc_id"]) == [(1, 2, 2), (4, 5, 5), (4, 5, 5)]
    assert kept.count() == 4
    assert sorted(found(near_copies(docs)), key=str) == sorted(found(near_copies(docs.select("doc_id", "text"))), key=str)
    assert without_near_copies(docs.limit(0)).count() == 0


def test_nothing_to_join(make_docs):
    assert near_copies(make_docs([])).count() == 0
    assert found(near_copies(make_docs([(1, None), (2, "x")]))) == [(1, 0, 1), (2, 0, 2)]


def test_components_of_a_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 400)] + [(1, 1)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 400)]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_all_pairs_of_an_oversized_bucket_meet_in_every_run(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "LOT", 10)
    rows = [(str(k).encode(), b"same path" * 40) for k in range(37)]
    sets = spark.createDataFrame([(k, s[: 4 * jaccard_join.FUNCTIONS]) for k, s in rows], "set_id binary, signature binary")
    buckets = defaultdict(set)
    for r in jaccard_join.leaf_buckets(sets).collect():
        assert bytes(r["set_id"]) not in buckets[r["bucket"]]
        buckets[r["bucket"]].add(bytes(r["set_id"]))
    assert max(map(len, buckets.values())) < 37
    met = Counter(p for b in buckets.values() for p in combinations(sorted(b), 2))
    assert len(met) == 37 * 36 // 2 and min(met.values()) >= jaccard_join.RUNS
    # documents that share a long passage, in pairs of near copies
    passage = " ".join(f"w{k}" for k in range(60))
    docs = [(k, f"{passage} " + " ".join(f"d{k // 2}x{j}" for j in range(45)) + f" e{k}") for k in range(60)]
    assert found(near_copies(make_docs(docs))) == brute(docs)


def test_large_buckets_connect_the_same_sets():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 256, (5, 64))
    sketches = centres[rng.integers(0, 5, 300)].astype(np.uint8)
    noise = rng.random(sketches.shape) < 0.15
    sketches[noise] = rng.integers(0, 256, noise.sum())
    i, j = bucket_links(sketches, np.zeros(300, np.int64))
    same = (sketches[:, None] == sketches[None]).mean(axis=2) >= 0.5518
    a, b = np.nonzero(np.triu(same, 1))
    one, two = local_roots(300, i, j), local_roots(300, a, b)
    assert len({(x, y) for x, y in zip(one, two, strict=True)}) == len(set(one)) == len(set(two))
