"""What a worker holds: workers serve all stages of a pipeline in turn."""

import gc
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import pytest
from revrecon.llm.common import batch_slices, held
from revrecon.llm.jaccard_join import shingles, similar_pairs
from revrecon.llm.quality import WIDTH, features
from revrecon.llm.tokens import reader, vocabulary_path


def peak_mb(work):
    tracemalloc.start()
    out = work()
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out, most


@pytest.mark.parametrize("other", [lambda: shingles(["a b c d e f"], 5), lambda: held("quality")])
def test_a_reader_goes_when_another_operator_asks(other):
    first = weakref.ref(reader(vocabulary_path()))
    assert reader(vocabulary_path()) is first()
    other()
    gc.collect()
    assert first() is None
    assert [x.tolist() for x in reader(vocabulary_path()).encode(["", "a"])][0] == []


def test_two_stages_in_one_worker(spark, make_docs):
    from revrecon.llm.line_dedup import dedup_lines
    from revrecon.llm.packing import pack

    docs = make_docs([(i, f"a line that stands in every document\nand one of its own {i}") for i in range(4)]).coalesce(1)

    def owners(batches):
        import pandas as pd
        from revrecon.llm import common

        for _ in batches:
            pass
        yield pd.DataFrame({"owners": [",".join(common._held)]})

    assert pack(docs).count() >= 4
    assert dedup_lines(docs).agg({"n_dropped": "sum"}).first()[0] == 3
    left = spark.range(64).repartition(16).mapInPandas(owners, "owners string").collect()
    assert all("," not in r["owners"] for r in left)


def test_two_full_tiles_of_near_copies_are_compared_in_little_memory():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 60, dtype=np.uint64)
    sets = [np.unique(np.append(base, rng.integers(0, 1 << 62, int(k), dtype=np.uint64))) for k in rng.integers(0, 12, 2048)]
    side = np.arange(2048) < 1024
    (i, j), most = peak_mb(lambda: similar_pairs(sets, side, 0.8))
    n = np.array([len(s) for s in sets])
    want = 60 >= 0.8 * (n[:, None] + n[None, :] - 60) - 1e-6
    want = np.nonzero(np.triu(want & (side[:, None] != side[None, :]), 1))
    assert (i == want[0]).all() and (j == want[1]).all()
    assert most < 80


def test_features_of_many_texts_take_little_memory():
    texts = [f"{'word, and. ' * 150}{i}\né" for i in range(1200)] + ["", "x" * 300_000]
    got, most = peak_mb(lambda: features(texts))
    assert most < 40
    assert got.shape == (len(texts), WIDTH) and features([]).shape == (0, WIDTH)
    for i in (0, 7, 1199, 1200, 1201):
        assert (got[i] == features([texts[i]])[0]).all()


def test_arrow_batches_are_cut_like_pandas_ones():
    texts = ["aaa", None, "é" * 4, "", "b" * 50, "c", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["n", "text"])
    parts = list(batch_slices([batch, batch.slice(0, 0)], "text", 5))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1], [2, 3], [4, 5, 6]]
    assert sum((p.column(1).to_pylist() for p in parts), []) == texts
    nothing = pa.RecordBatch.from_arrays([pa.nulls(3)], names=["text"])
    assert [p.num_rows for p in batch_slices([nothing], "text")] == [3]
