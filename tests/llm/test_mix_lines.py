"""Mixing and line removal against SQL on the supplied tables and against plain Python on small odd ones."""

import re
from collections import defaultdict

import numpy as np
import pytest
from checks.compare import difference, duck
from revrecon.llm.line_dedup import Shard, dedup_lines, shard_row
from revrecon.llm.mixing import mix, repeated
from revrecon.llm.queries import ORACLES, REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert difference(REGISTRY[name](spark, SF), duck(SF), ORACLES[name]) is None


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_reaches_its_targets(make_docs):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 60)), s) for i, s in enumerate(rng.choice(["a", "b", "c", "d", None], 3000, p=[0.5, 0.3, 0.1, 0.05, 0.05]))]
    rows = [(i, t, None if s == "None" else s) for i, t, s in rows]
    got = mix(make_docs(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert r["mix_size"] == words(r["text"]) and 0 <= r["mix_copies"] <= 3
        sizes[r["source"]] += r["mix_size"]
        taken[r["source"]] += r["mix_size"] * r["mix_copies"]
        target[r["source"]] = r["mix_target"]
    weight = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    want, free = {}, dict(weight)
    while True:
        left = sum(sizes.values()) - sum(want.values())
        over = [s for s in free if left * free[s] / sum(free.values()) > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            want[s] = 3 * sizes[s]
            del free[s]
    want |= {s: left * w / sum(free.values()) for s, w in free.items()}
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 61
    again = mix(make_docs(rows).repartition(7)).collect()
    assert sorted((r["doc_id"], r["mix_copies"]) for r in again) == sorted((r["doc_id"], r["mix_copies"]) for r in got)


def test_mix_tells_equal_rows_apart(make_docs):
    rows = [(None, "a b c", "x")] * 300 + [(1, "a b", "y")] * 300 + [(2, None, "z"), (3, "", None)]
    docs = make_docs(rows)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    for s in ("x", "y"):
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["mix_size"] * r["mix_copies"] for r in mine) - mine[0]["mix_target"]) <= 3
    copies = repeated(mix(docs), docs.columns)
    assert copies.columns == docs.columns and copies.count() == sum(r["mix_copies"] for r in got)
    assert mix(make_docs([])).count() == 0


def brute_lines(rows):
    low = -(1 << 63)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(list)
    for doc_id, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(low if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        me, lines = low if doc_id is None else doc_id, (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == me]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LONG = "Ünïcode line that has more than twenty"
ROWS = [
    (1, f"{LONG}\nother\n\t{LONG.upper().replace('Ü', 'Ü')} \r"),
    (2, f"{LONG}  \n\nend"),
    (7, f"x\n{LONG}\n{LONG}"),
    (7, f"x\n{LONG}\n{LONG}"),
    (None, f"{LONG}\n" + "line of twenty chars\n" * 3),
    (None, "LINE OF TWENTY CHARS\n\n\n"),
    (None, "line of twenty chars"),
    (3, None),
    (4, ""),
    (5, "nineteen characters\n" * 4),
    (6, "nineteen characters"),
    (8, "nineteen characters\nword " * 3000),
]


@pytest.mark.parametrize("sent_mb", [64, 0])
def test_lines_match_a_plain_count(make_docs, sent_mb):
    got = dedup_lines(make_docs(ROWS), sent_mb=sent_mb).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got), key=repr) == brute_lines(ROWS)
    assert {r["size"] for r in got} == {"x"}


def test_lines_of_no_documents(make_docs):
    assert dedup_lines(make_docs([])).count() == 0
    assert [r["text"] for r in dedup_lines(make_docs([(1, None)])).collect()] == [""]


@pytest.mark.parametrize("n", [1, 7, 20_000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys, marks = (rng.integers(-(1 << 63), (1 << 63) - 1, 2 * n) for _ in range(2))
    keys[: n // 2] = keys[0]
    counts, last = rng.integers(3, 99, n).astype(np.int32), rng.integers(0, 1 << 40, n)
    shard = Shard.load(shard_row(0, keys[:n], marks[:n], counts, last))
    assert sorted(shard.numbers(keys[:n], marks[:n])) == list(range(n))
    got = shard.probe(keys[:n], marks[:n])
    assert (got[0] == counts).all() and (got[1] == last).all()
    assert (shard.probe(keys[n:], marks[n:])[0] == 0).all()
