"""Token ids, their compressed files and packing, against plain Python over the same texts."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from revrecon.llm import rans
from revrecon.llm.binary_output import read_ids, write_ids
from revrecon.llm.packing import OpenWindows, best_fit_decreasing, pack
from revrecon.llm.queries import REGISTRY
from revrecon.llm.tokens import TokenReader, vocabulary_path
from tokenizers.pre_tokenizers import Split

SF = "/root/testdata/sf0.001"
ODD = [None, "", "  a\t b\n\n<|endoftext|> x", "é ́ I'm DON'T's    z\x1cq", "ΑΣ ΣΑΣ. İ", "x., y. z, … . ok…. 12 345 !?!", "word " * 9000]


@pytest.fixture(scope="module")
def tokens():
    return TokenReader(vocabulary_path())


def expected(tokens, text, end):
    ids = [*tokens.library.encode(text or "", add_special_tokens=False).ids, end]
    return ids, zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunks_give_the_ids_of_the_whole_text(tokens):
    for text, ids in zip(ODD[1:], tokens.encode(ODD[1:]), strict=True):
        assert ids.tolist() == tokens.library.encode(text, add_special_tokens=False).ids


def test_a_chunk_is_looked_up_once_for_all_its_places(tokens):
    class Counting(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    read = TokenReader(vocabulary_path())
    read.known = Counting(read.known)
    texts = ["one two, " * 5000, "two one. " * 5000]
    for text, ids in zip(texts, read.encode(texts), strict=True):
        assert ids.tolist() == tokens.library.encode(text, add_special_tokens=False).ids
    assert read.known.asked < 50


@pytest.mark.parametrize("kept", [1, 3, 8])
def test_chunks_dropped_from_the_cache_are_learned_again(tokens, monkeypatch, kept):
    monkeypatch.setattr("revrecon.llm.tokens.KEPT", kept)
    read = TokenReader(vocabulary_path())
    for texts in (["a b c d", ""], ["é e f, a", "<|endoftext|> b"], ["", ""], [], ["b c g. h i j k l é", "a a a"]):
        for text, ids in zip(texts, read.encode(texts), strict=True):
            assert ids.tolist() == tokens.library.encode(text, add_special_tokens=False).ids


def test_plain_words_through_the_bare_model_have_the_same_ids(tokens, monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(1, 14))) for _ in range(3000)]
    text = " ".join(words + [t.removesuffix("</w>") for t in tokens.library.get_vocab()][::9])
    assert tokens.bare is not tokens.library
    assert TokenReader(vocabulary_path()).encode([text])[0].tolist() == tokens.library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr("revrecon.llm.tokens.WhitespaceSplit", lambda: Split("a", "removed"))
    other = TokenReader(vocabulary_path())
    assert other.bare is other.library


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 5000, 300_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.uint32)
    seen, counts = np.unique(np.append(ids, 7), return_counts=True)
    table = rans.Table(seen, counts)
    docs = np.split(ids, [n // 3, n // 3, n // 2])
    block = rans.encode(docs, table)
    assert [d.tolist() for d in rans.decode(block, table)] == [d.tolist() for d in docs]
    broken = bytearray(block)
    broken[-1 if n else 32] ^= 255
    with pytest.raises((ValueError, IndexError)):
        rans.decode(bytes(broken), table)
    parsed = rans.parse(block)
    if len(parsed["points"]) > 1:
        lo = parsed["points"][1][0] * parsed["lanes"]
        part = rans.decode_part(parsed, table, 1)
        assert part.tolist() == ids[lo : lo + len(part)].tolist()


def test_files_hold_every_document_in_order(spark, make_docs, tokens, tmp_path):
    rows = [(i * 7 % 50, t) for i, t in enumerate(ODD * 4)] + [(None, "no id"), (None, "no id"), (3, "same id")]
    got = read_ids(spark, *write_ids(make_docs(rows).repartition(5), str(tmp_path / "files"))).collect()
    order = sorted(got, key=lambda r: r["start"])
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert keys == sorted(keys)
    start = 0
    for r in order:
        assert r["start"] == start
        start += len(r["ids"]) // 4
    assert sorted((r["doc_id"] or -1, zlib.crc32(r["ids"])) for r in got) == sorted((d or -1, expected(tokens, t, 1)[1]) for d, t in rows)


def test_empty_tables(spark, make_docs, tmp_path):
    none = make_docs([])
    assert read_ids(spark, *write_ids(none, str(tmp_path / "files"))).count() == 0
    assert pack(none).count() == 0


def test_token_query_on_the_whole_table(spark, tokens):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    start = 0
    rows = {r["doc_id"]: r for r in REGISTRY["op9_token_output"](spark, SF).collect()}
    assert set(rows) == set(texts)
    for doc_id in sorted(texts):
        ids, crc = expected(tokens, texts[doc_id], 1)
        assert (rows[doc_id]["start"], rows[doc_id]["n_tokens"], rows[doc_id]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_tightest_window_is_taken():
    opened = OpenWindows(16)
    for name, room in enumerate([5, 9, 9, 16, 2]):
        opened.add(room, name)
    assert opened.take(3)[0] == 5
    assert opened.take(3)[0] == 9
    assert opened.take(10)[0] == 16
    assert opened.take(10) is None
    assert opened.take(16) is None


def test_best_fit_decreasing_matches_a_plain_search():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 65, 500).tolist()
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(64 - n)
    windows = best_fit_decreasing(lengths, 64)
    assert sorted(i for w in windows for i in w) == list(range(500))
    assert sorted(64 - sum(lengths[i] for i in w) for w in windows) == sorted(rooms)


def check_packing(rows, texts, tokens, window=4096):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(docs) == set(texts)
    for doc_id, pieces in docs.items():
        ids, _ = expected(tokens, texts[doc_id], 2)
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            part = ids[at : at + p["length"]]
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding <= 0.01 * total + window


def test_packing_of_the_whole_table(spark, tokens):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packing(REGISTRY["op2_packing"](spark, SF).collect(), texts, tokens)


def test_packing_of_odd_rows(make_docs, tokens):
    rows = dict(enumerate(ODD))
    got = pack(make_docs(list(rows.items()))).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(got.collect(), rows, tokens)
    twice = pack(make_docs([(None, "same"), (None, "same"), (4, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["length"]) for r in twice) == [(-1, 2), (-1, 2), (4, 1)]
