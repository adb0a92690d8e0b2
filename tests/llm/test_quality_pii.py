"""Quality scores by held-out accuracy; personal data against plain regular expressions."""

import hashlib
import re
import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F
from revrecon.llm import quality
from revrecon.llm.personal_data import KINDS, boost, find_personal_data, threshold
from revrecon.llm.quality import drawn, fit_ranker, learn, quantile_cut, score_quality
from revrecon.llm.queries import REGISTRY

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def test_quality_of_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in REGISTRY["op3_quality"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(rows[x["doc_id"]]["predicted"], x["quality"]) for x in labels if rows[x["doc_id"]]["held_out"]]
    assert np.mean([p == q for p, q in held]) >= 0.95


def test_quality_without_labels_and_odd_texts(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "x"), (None, "x"), (4, "long text " * 30_000)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["quality_score"] for r in score_quality(docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1), (2, 1), (4, 0), (4, None), (None, 0), (99, 0)], "doc_id long, quality int")
    got = score_quality(docs, some).collect()
    assert len(got) == 5 and all(0 <= r["quality_score"] <= 1 for r in got)
    assert {r["size"] for r in got} == {"x"}
    assert score_quality(make_docs([]), some).count() == 0
    named = docs.withColumn("quality_score", F.lit("mine")).withColumn("Quality_Kept", F.lit(1)).withColumn("x", F.lit(2))
    again = score_quality(named, some)
    assert again.columns == [*docs.columns, "x", "quality_score", "quality_kept"]
    assert sorted(r["quality_score"] for r in again.collect()) == sorted(r["quality_score"] for r in got)


def test_ranker_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    good = x @ np.array([1, -2, 0, 0, 0.5]) > 0.3
    ranker = fit_ranker(x, good)
    raw = ((x - ranker.mean) / ranker.spread) @ ranker.weights
    cut = quantile_cut(raw, good, np.ones(len(good)))
    assert ((raw > cut) == good).mean() > 0.98


def test_fit_uses_every_document_in_little_memory():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, quality.WIDTH))
    good = x @ rng.normal(size=quality.WIDTH) > 0
    tracemalloc.start()
    ranker = fit_ranker(x, good)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    assert (((x - ranker.mean) / ranker.spread @ ranker.weights > 0) == good).mean() > 0.9
    for size in (3, 10_000, 70_000):
        times = np.bincount(drawn(np.arange(size), max(size, quality.PAIRS), rng), minlength=size)
        assert 1 <= times.min() and times.max() <= times.min() + 1


def test_repeated_rows_weigh_once_in_the_fit(spark, make_docs):
    rows = [(k, f"{'Good, plain words' if k % 2 else 'bad bad %% ##'} {k} " * (1 + k % 7)) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    want = learn(make_docs(rows), labels)
    got = learn(make_docs(rows + [r for r in rows if r[0] in (3, 4)] * 100), labels)
    assert np.allclose(got.mean, want.mean) and np.allclose(got.weights, want.weights) and np.isclose(got.shift, want.shift)
    several = learn(make_docs(rows + [(3, f"other {k}") for k in range(100)]), labels)
    assert np.isfinite(several.weights).all()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = [
        (m.start(), KINDS.index(kind), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    return sorted(spans)


def test_personal_data_of_the_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = REGISTRY["op8_personal_data"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]])
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(text.split(",")) <= set(r["spans"].split(","))


ODD = [
    None,
    "",
    "a@b.c a@b.c_x@d.e é😀 x@y.z@w.v foo@bar -@-.- a@b.c.d..e",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.003.4 255.255.255.256 1.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000000000 411111111111111122222",
    "+1 (017) 555-7713 +49 30 1234567 ++123456789 +1 +123 +1....2 (+44)20 7946 0958.",
    "٣٤ ＠ 4111111111111111é1.1.1.1",
    "a" * 50_000 + "@b.c " + "1" * 50_000 + " " + "7 " * 20_000 + ".".join(["9"] * 5_000),
    "mail x@y.com, " * 1500,
]


def test_personal_data_of_odd_texts(make_docs):
    rows = [*enumerate(ODD), (None, "a@b.c"), (None, "a@b.c")]
    got = find_personal_data(make_docs(rows)).collect()
    assert len(got) == len(rows)
    texts = dict(enumerate(ODD)) | {None: "a@b.c"}
    for r in got:
        base = [tuple(s) for s in r["base"]]
        assert base == plain(texts[r["doc_id"]])
        assert set(base) <= {tuple(s) for s in r["spans"]}
    assert find_personal_data(make_docs([])).count() == 0


def test_trees_learn_and_the_threshold_keeps_its_precision():
    names = ("kind", "digits", "letters", "marks", "before", "after", "cue", "even", "length")
    rows = [({n: 0 for n in names} | {"digits": d, "cue": c}, 90.0 * (d == 5 and c), 10.0 + 90.0 * (d != 5)) for d in range(8) for c in (0, 1)]
    first, trees = boost(rows)
    assert threshold(rows, first, trees, 0.85) < threshold(rows, first, trees, 0.89) or trees
    assert threshold(rows, first, trees, 0.99) == float("inf")
    assert threshold([], first, trees, 0.5) == float("inf")
