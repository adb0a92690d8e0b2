"""The pipeline's stages against plain Python over each stage's own input."""

from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F
from revrecon.llm.common import settle
from revrecon.llm.mixing import mix
from revrecon.llm.quality import score_quality
from test_jaccard import brute
from test_mix_lines import brute_lines, words
from test_tokens_out import check_packing
from revrecon.llm.tokens import TokenReader, vocabulary_path

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.select(*cp.COLUMNS).collect()]


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    outs, now = [], docs
    for name, stage in cp.STAGES[:-1]:
        now = settle(stage(spark, now, SF), name.replace(" ", "-"))
        assert now.columns == docs.columns
        outs.append(now)
    start, good, lines, single, mixed = rows(docs), *map(rows, outs)

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    scored = score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r["doc_id"] for r in scored.where("quality_score >= 0.3").collect()}
    assert sorted(good) == sorted(r for r in start if r[0] in kept)
    assert sum(labels.get(r[0]) == 1 for r in good) >= 0.95 * sum(labels.get(r[0]) == 1 for r in start)

    want = {d: t for d, _, _, t in brute_lines([(r[0], r[1]) for r in good])}
    assert sorted(lines) == sorted((r[0], want[r[0]], r[2], r[3], len(want[r[0]])) for r in good)

    classes = {d: c for d, _, c in brute([(r[0], r[1]) for r in lines])}
    assert sorted(single) == sorted(r for r in lines if classes[r[0]] == r[0])

    times = Counter(r[0] for r in mixed)
    copies = {r["doc_id"]: (r["mix_copies"], r["mix_target"], r["source"]) for r in mix(outs[2]).collect()}
    assert times == Counter({d: c for d, (c, _, _) in copies.items() if c})
    for source in {s for _, _, s in copies.values()}:
        target = next(t for _, t, s in copies.values() if s == source)
        mine = [r for r in single if r[3] == source]
        taken = sum(words(r[1]) * times[r[0]] for r in mine)
        assert abs(taken - target) <= max((words(r[1]) for r in mine), default=0) + 1

    last = cp.STAGES[-1][1](spark, outs[-1].dropDuplicates(["doc_id"]), SF).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(last.collect(), {r[0]: r[1] for r in mixed}, TokenReader(vocabulary_path()))


def test_whole_run(spark):
    got = cp.run(spark, SF)
    assert got.columns[:4] == ["doc_id", "doc_tokens", "start", "length"]
    assert got.count() > 0


def test_stages_on_odd_documents(spark, make_docs):
    odd = make_docs([(1, None), (None, "a b c d e f"), (None, "a b c d e f"), (2, ""), (3, "w " * 50_000), (4, "x", None)])
    odd = odd.select(*cp.COLUMNS)
    for docs in (odd, odd.limit(0)):
        for _, stage in cp.STAGES:
            docs = settle(stage(spark, docs, SF), "odd")
        assert docs.count() >= 0
