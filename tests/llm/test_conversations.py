"""Repair of conversations against an exhaustive search, and against the SQL."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from checks.compare import difference, duck
from pyspark.sql import types as T
from revrecon.llm import conversation_repair, viterbi
from revrecon.llm.conversation_repair import damage, op11_conversation_repair, repair
from revrecon.llm.queries import ORACLES, REGISTRY

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("chunk", T.StringType()),
        T.StructField("conv", T.StringType()),
        T.StructField("key", T.StringType()),
    ]
)
WHITE = " \t\n\x0b\x0c\r"


def make(spark, rows):
    return spark.createDataFrame([(*r, "c", None, "k") for r in rows], SCHEMA)


def least(rows):
    """(cost, audit, lines) of the cheapest repair by trying every edit; rows are (role, text, must go, truncated)."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 2:  # three in a row never help
            for x in after[state].replace("s", ""):
                c, audit, lines = best(i, x, inserts + 1)
                options.append((c + 5, "I" + audit, ({"u": "user", "a": "assistant"}[x] + ":", *lines)))
        if i < len(rows):
            role, text, must_go, late = rows[i]
            c, audit, lines = best(i + 1, state, 0)
            options.append((c + 2, "D" + audit, lines))
            if not must_go:
                if role[:1] and role[:1] in after[state]:
                    c, audit, lines = best(i + 1, role[:1], 0)
                    options.append((c + 5 * late, "K" + audit, (f"{role}:{text}", *lines)))
                for x in after[state].replace("s", ""):
                    c, audit, lines = best(i + 1, x, 0)
                    options.append((c + 1 + 5 * late, "R" + audit, ({"u": "user", "a": "assistant"}[x] + ":" + text, *lines)))
        return min(options, key=lambda o: o[:2], default=(10**9, "", ()))

    return best(0, "", 0)


def said(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def expected(rows):
    """What :func:`repair` must report, per conversation."""
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, said(*r[1:])))
        seen, facts, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            last = text.rstrip(WHITE)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            facts.append((role, text, fault in (0, 1), fault == 2))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        cost, audit, lines = least(tuple(facts))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        yield from [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


def reports(found):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.sha) for r in found.collect()}


def talk(rng, n_conv=40, most=14):
    rows = []
    for conv in [*range(n_conv), None]:
        roles = ["system"] * rng.randint(0, 2) + ["user", "assistant"] * rng.randint(0, most // 2)
        for turn, role in enumerate(roles):
            if rng.random() < 0.2:
                role = rng.choice(["user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice([f"Text {turn}.", f"Text {rng.randint(0, 3)}!", "no end", "", None, " \n\t", "Ends here. \n", "été ✓?"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None, 2]), role, text))
    return rows


def test_one_step_against_all_edits():
    rng = random.Random(1)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3, 4, 5, 6, 7]) for _ in range(rng.randint(0, 7)))
        rows = tuple((["system", "user", "assistant", "x"][c % 4], "t", False, c >= 4) for c in codes)
        cost, audit, _ = least(rows)
        vectors = viterbi.trail(codes, viterbi.FINAL)
        assert viterbi.run(codes, viterbi.FINAL) == vectors[0] and vectors[0][viterbi.E] == cost
        edits, end = viterbi.trace(codes, vectors, viterbi.E, True)
        assert "".join(edits) == audit and end in (viterbi.E, viterbi.A)


def test_a_rerun_stops_where_vectors_are_parallel():
    rng = random.Random(2)
    codes = bytes(rng.choice([1, 2]) for _ in range(400))
    guess = viterbi.run(codes, viterbi.FINAL)
    stepped = []
    for tail in [(0, 3, 5, 0), (0, 0, 0, 0), (5, 5, 0, 5), (10, 10, 5, 0)]:
        got, done = viterbi.rerun(codes, tail, viterbi.FINAL, guess)
        assert got == viterbi.run(codes, tail)
        stepped.append(done)
    assert max(stepped) < 40


@pytest.mark.parametrize("chunk, task_bytes", [(256, 1 << 26), (2, 300)])
def test_repair_against_all_edits(spark, chunk, task_bytes):
    rows = talk(random.Random(7))
    found, _ = repair(make(spark, rows), chunk=chunk, task_bytes=task_bytes)
    assert reports(found) == expected(rows)


def long_ones():
    rng = random.Random(11)
    yield ["user", "assistant"] * 60, lambda i: f"t{i}."
    yield ["tool"] * 121, lambda i: f"t{i}."  # vectors never become parallel
    yield ["tool"] * 60 + ["user"] + ["tool"] * 50, lambda i: f"t{i}."
    yield ["user"] * 100, lambda i: "same."
    yield ["user"] * 90 + ["assistant"], lambda i: "" if i < 89 else "x."
    yield [rng.choice(["user", "assistant", "tool", "system"]) for _ in range(120)], lambda i: f"t{i % 50}" + "." * (i % 3)


def test_long_conversations_over_many_chunks_and_tasks(spark, monkeypatch):
    rows = [(n, i, role, text(i)) for n, (roles, text) in enumerate(long_ones()) for i, role in enumerate(roles)]
    rows += [(9, 0, "user", "Hi."), (9, 1, "assistant", "Yes.")]
    passes = []
    run = conversation_repair._run_chunks
    monkeypatch.setattr(conversation_repair, "_run_chunks", lambda light, tails: passes.append(1) or run(light, tails))
    found, _ = repair(make(spark, rows), chunk=8, task_bytes=400)
    assert reports(found) == expected(rows)
    assert len(passes) <= 7  # some fifteen chunks each


def test_repaired_rows_are_in_order_and_legal(spark):
    rows = talk(random.Random(9))
    found, repaired = repair(make(spark, rows), chunk=4, task_bytes=500)
    digests = {r.conv_id: r.sha for r in found.collect()}
    by = {}
    for r in repaired.orderBy("chunk", "place").collect():
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv, own in digests.items():
        lines = by.get(conv, [])
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest() == own
        assert re.fullmatch("(s?(ua)+)?", "".join(a[:1] for a, _ in lines))


def test_damage(spark):
    rows = talk(random.Random(5)) + [(None, None, None, None)]
    got = sorted(map(repr, (tuple(r) for r in damage(make(spark, rows)).collect())))
    assert got == sorted(map(repr, damaged(rows)))


def test_the_query_on_odd_rows(spark, tmp_path):
    rows = talk(random.Random(3), 60) + [(900 + i, 0, "user", "One.") for i in range(40)] + [(5, 1, "user", "word " * 400_000)]
    make(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    want = expected(list(damaged(rows)))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {r[0]: want.get(r[0], nothing) for r in rows}
    assert nothing in got.values()


def test_an_empty_table(spark):
    found, repaired = repair(make(spark, []))
    assert found.collect() == [] and repaired.collect() == []


def test_query_equals_sql(spark):
    assert difference(REGISTRY["op11_conversation_repair"](spark, SF), duck(SF), ORACLES["op11_conversation_repair"]) is None
