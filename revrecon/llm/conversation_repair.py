"""Repair of the structure of conversations by a parallel Viterbi search whose chunks converge in rank."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from revrecon.llm import viterbi
from revrecon.llm.common import settle, table
from revrecon.llm.viterbi import FINAL, FOLLOWS, ROLE_OF, kind_of, normal

#: Rows and characters of a chunk (a longer row is a chunk of its own), and bytes of text that a task sorts.
CHUNK, CHUNK_CHARS, TASK_BYTES = 256, 1 << 20, 64 << 20
#: Marks of rows by their first fault.
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)
#: Pairs of neighbours that are in order.
LEGAL = ("su", "ua", "au")
#: Passes after which every chunk of an open conversation is run on every vector that was met in it.
PLAIN_PASSES = 3
_WHITE = " \t\n\x0b\x0c\r"
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults of the contract, set by crc32 of ``conv_id:turn``; nulls read as a space."""
    spoken = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    at = F.pmod(F.crc32(F.concat(spoken("conv_id"), F.lit(":"), spoken("turn"))), F.lit(20))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), spoken("role").alias("role"), spoken("text").alias("text"), at.alias("at"))
    text = F.when(F.col("at") == 1, "").when(F.col("at") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("at") == 4, "user").otherwise(F.col("role"))
    twice = F.when(F.col("at") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("at <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(twice).alias("copy")).drop("copy")


def _in_order(conversations: DataFrame, task_bytes: int) -> DataFrame:
    """The rows sorted by conversation and turn over many tasks, a long conversation over several. They are stored
    first: the number that deals out equal rows then stays what it is if a task runs again."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", conv.alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    last = F.right(F.rtrim(F.col("text"), F.lit(_WHITE)), F.lit(1))
    mark = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(CUT_OFF)
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    stored = settle(rows.withColumns({"mark": mark, "key": F.unhex(F.sha2(said, 256)), "size": F.octet_length("text")}), "conversations")
    bytes_ = stored.agg(F.sum("size")).first()[0] or 0
    placed = stored.drop("size").withColumn("salt", F.monotonically_increasing_id())
    order = ["conv", "turn", "key", "salt"]
    return placed.repartitionByRange(1 + bytes_ // task_bytes, *order).sortWithinPartitions(*order)


def _digest(digest: hashlib._Hash, begun: bool, roles: list[str], texts: list[str]) -> bool:
    for role, text in zip(roles, texts, strict=True):
        digest.update(("\n" if begun else "").encode() + role.encode() + b":" + text.encode())
        begun = True
    return begun


def _required(marks: bytes) -> list[bool]:
    return [m in (BLANK, DUPLICATE) for m in marks]


def _codes(kinds: bytes, marks: bytes) -> bytes:
    """The rows that may stay, as :mod:`viterbi` reads them. A row that must go costs the same in every state."""
    return bytes(k + (viterbi.LATE if m == CUT_OFF else 0) for k, m in zip(kinds, marks, strict=True) if m not in (BLANK, DUPLICATE))


def _edited(roles: list[str], texts: list[str], marks: bytes, edits: list[str], state: int) -> tuple[str, int, list[str], list[str]]:
    """Audit, cost and repaired rows of a chunk. Rows that must go are deleted before any insert at their place."""
    audit, cost, out_roles, out_texts, at = [], 0, [], [], 0

    def add(role: str, text: str) -> None:
        out_roles.append(role)
        out_texts.append(text)

    def apply(letters: str, role: str, text: str, late: int) -> None:
        nonlocal cost, state
        for letter in letters:
            if letter == "D":
                cost += viterbi.DELETE
                continue
            follow = FOLLOWS[state]
            if letter == "I":
                cost += viterbi.INSERT
                add(ROLE_OF[follow], "")
            elif letter == "R":
                cost += viterbi.REROLE + late
                add(ROLE_OF[follow], text)
            else:
                cost += late
                add(role, text)
                follow = viterbi.S if state == viterbi.E and kind_of(role) == viterbi.SYSTEM else follow
            state = follow

    for role, text, mark, must_go in zip(roles, texts, marks, _required(marks), strict=True):
        letters = "D" if must_go else edits[at]
        at += not must_go
        audit.append(letters)
        apply(letters, role, text, viterbi.TRUNCATED if mark == CUT_OFF else 0)
    for letters in edits[at:]:
        audit.append(letters)
        apply(letters, "", "", 0)
    return "".join(audit), cost, out_roles, out_texts


class _Open:
    """Rows of one conversation that the chunk at hand has gathered."""

    def __init__(self, conv_id, conv: str, early: bool, limits: tuple[int, int]):
        self.conv_id, self.conv, self.early, self.limits, self.n_chunks = conv_id, conv, early, limits, 0
        self.clear()

    def clear(self) -> None:
        self.roles, self.texts, self.marks, self.keys, self.turns, self.chars = [], [], bytearray(), [], [], 0

    def full(self, text: str) -> bool:
        return bool(self.roles) and (len(self.roles) >= self.limits[0] or self.chars + len(text) > self.limits[1])

    def add(self, turn, role: str, text: str, mark: int, key: bytes) -> None:
        for at, one in ((self.roles, role), (self.texts, text), (self.keys, key), (self.turns, turn)):
            at.append(one)
        self.marks.append(mark)
        self.chars += len(text)


def _chunk(held: _Open, number: int, alone: bool) -> dict:
    """A chunk as a row: counts of its own, and either the finished repair or what the passes and the repair need."""
    seen, places = {}, []
    for at, key in enumerate(held.keys):
        if held.marks[at] == BLANK:
            continue
        if key in seen:
            held.marks[at] = DUPLICATE
        else:
            seen[key] = at
            places.append(at)
    marks, turns = bytes(held.marks), [t for t in held.turns if t is not None]
    initials = [r[:1] for r in held.roles]
    row = {
        "conv_id": held.conv_id, "conv": held.conv, "chunk": number, "alone": alone, "marks": marks,
        "kinds": bytes(kind_of(r) for r in held.roles),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "first_role": initials[0], "last_role": initials[-1],
        "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "n_turns": len(set(turns)),
    }
    if not alone:
        return row | {"keys": [held.keys[p] for p in places], "places": places, "roles": held.roles, "texts": held.texts}
    codes = _codes(row["kinds"], marks)
    edits, _ = viterbi.trace(codes, viterbi.trail(codes, FINAL), viterbi.E, True)
    audit, cost, roles, texts = _edited(held.roles, held.texts, marks, edits, viterbi.E)
    digest = hashlib.sha256()
    _digest(digest, False, roles, texts)
    return row | {"audit": audit, "cost": cost, "sha": digest.hexdigest(), "roles": roles, "texts": texts} | _counted(marks)


def _counted(marks: bytes) -> dict[str, int]:
    return {"blank": marks.count(BLANK), "duplicate": marks.count(DUPLICATE), "truncated": marks.count(CUT_OFF)}


def _chunk_shape(kind: str) -> str:
    return (
        f"conv_id {kind}, conv string, chunk long, alone boolean, marks binary, kinds binary, illegal long, first_role string, "
        "last_role string, first_turn long, last_turn long, n_turns long, audit string, cost long, sha string, blank long, duplicate long, truncated long, "
        "keys array<binary>, places array<int>, roles array<string>, texts array<string>"
    )


def _batches(rows: Iterator[tuple[dict, int]], shape: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``most`` characters."""
    held, chars = [], 0
    for row, size in rows:
        held.append(row)
        chars += 200 + size
        if chars >= most:
            yield pa.RecordBatch.from_pylist(held, shape)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, shape)


def _mapped(df: DataFrame, ddl: str, work) -> DataFrame:
    """``df`` through ``work``, which turns dicts of rows into (dict, size) pairs in the order of the partition."""
    names, arrow = df.columns, to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                yield from batch.slice(lo, 256).to_pylist()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(work(rows(batches)), arrow)

    return df.select(*names).mapInArrow(mapped, ddl)


def _chunks(ordered: DataFrame, limits: tuple[int, int]) -> DataFrame:
    """The sorted rows as chunks, numbered in their order over all tasks. A conversation that lies in one chunk and
    touches neither end of its task's rows is repaired at once."""

    def work(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        number, held = TaskContext.get().partitionId() << 40, None

        def cut(alone: bool) -> tuple[dict, int]:
            nonlocal number
            out, size = _chunk(held, number, alone), held.chars
            number, held.n_chunks = number + 1, held.n_chunks + 1
            held.clear()
            return out, size

        for r in rows:
            if held is None or r["conv"] != held.conv:
                if held is not None:
                    yield cut(not held.early and not held.n_chunks)
                held = _Open(r["conv_id"], r["conv"], held is None, limits)
            elif held.full(r["text"]):
                yield cut(False)
            held.add(r["turn"], r["role"], r["text"], r["mark"], bytes(r["key"]))
        if held is not None:
            yield cut(False)

    return _mapped(ordered, _chunk_shape(ordered.schema["conv_id"].dataType.simpleString()), work)


def _without_later_copies(chunks: DataFrame) -> DataFrame:
    """conv, chunk, kinds, marks of the chunks of long conversations; rows that an earlier chunk holds are duplicates.

    Each chunk offers a text once, so a text that fills a conversation costs one row per chunk.
    """
    light = chunks.where("not alone").select("conv", "chunk", "kinds", "marks", "keys", "places")
    offers = light.select("conv", "chunk", F.explode(F.arrays_zip("keys", "places")).alias("o")).select("conv", F.col("o.keys").alias("key"), F.struct("chunk", F.col("o.places").alias("place")).alias("at"))
    first = offers.groupBy("conv", "key").agg(F.min("at").alias("first"))
    again = offers.join(first, ["conv", "key"]).where("at > first").groupBy(F.col("at.chunk").alias("chunk")).agg(F.collect_list("at.place").alias("again"))

    def work(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for r in rows:
            marks = bytearray(r["marks"])
            for at in r["again"] or ():
                marks[at] = DUPLICATE
            yield {"conv": r["conv"], "chunk": r["chunk"], "marks": bytes(marks), "codes": _codes(r["kinds"], marks)}, len(marks)

    joined = light.select("conv", "chunk", "kinds", "marks").join(again, "chunk", "left")
    return settle(_mapped(joined, "conv string, chunk long, marks binary, codes binary", work), "light-chunks")


_PAIR = "conv string, chunk long, tail array<int>, head array<int>, plus long"


def _run_chunks(light: DataFrame, tails: DataFrame | None) -> DataFrame:
    """For every chunk and asked tail vector the vector before the chunk; without ``tails`` for the speculative one.

    Vectors have least entry 0; ``plus`` is what a chunk adds besides. A rerun goes beside the speculative run and stops
    where both differ by a constant.
    """

    def work(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for r in rows:
            codes, guess = r["codes"], viterbi.run(r["codes"], FINAL)
            for tail in map(tuple, r.get("tails") or [FINAL]):
                head, plus = normal(viterbi.rerun(codes, tail, FINAL, guess)[0])
                yield {"conv": r["conv"], "chunk": r["chunk"], "tail": list(tail), "head": list(head), "plus": plus}, 60

    asked = light.select("conv", "chunk", "codes")
    if tails is not None:
        asked = asked.join(tails.groupBy("chunk").agg(F.collect_set("tail").alias("tails")), "chunk")
    return _mapped(asked, _PAIR, work)


def _stitch(pairs: DataFrame) -> DataFrame:
    """conv, chunk, tail, known: each chunk's tail as its successor's head says, from the last chunk on; a chunk that
    was not run on that tail yet is not known, and the walk goes on with what it was run on."""

    def work(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        conv, chunk, now, heads = None, None, FINAL, {}

        def leave() -> dict:
            return {"conv": conv, "chunk": chunk, "tail": list(now), "known": now in heads}

        for r in rows:
            if (r["conv"], r["chunk"]) != (conv, chunk):
                if chunk is not None:
                    yield leave(), 40
                    now = heads.get(now) or next(iter(heads.values()))
                if r["conv"] != conv:
                    now = FINAL
                conv, chunk, heads = r["conv"], r["chunk"], {}
            heads[tuple(r["tail"])] = tuple(r["head"])
        if chunk is not None:
            yield leave(), 40

    order = [F.col("conv"), F.col("chunk").desc(), F.col("tail")]
    return _mapped(pairs.repartition("conv").sortWithinPartitions(*order), "conv string, chunk long, tail array<int>, known boolean", work)


def _true_tails(light: DataFrame) -> DataFrame:
    """conv, chunk, tail: the true cost vector after every chunk, but for a constant.

    All chunks first run on one speculative vector, the one of a sequence's end. Passes then rerun the chunks whose
    successor's head is a vector that they were not run on, until none is left. As vectors forget their end within a few
    rows, that is one more pass as a rule. Rows that keep two vectors apart for good (roles that are never legal) would
    need a pass per chunk: after ``PLAIN_PASSES`` the chunks of such a conversation run on all vectors that it has met,
    and as few vectors exist, a few passes do.
    """
    pairs, passes = settle(_run_chunks(light, None), "vectors"), 0
    while True:
        tails = settle(_stitch(pairs), "tails")
        open_ = tails.where("not known").drop("known")
        if open_.isEmpty():
            return tails.drop("known")
        passes += 1
        if passes >= PLAIN_PASSES:
            met = pairs.groupBy("conv").agg(F.collect_set("head").alias("met")).join(open_.select("conv").distinct(), "conv")
            all_ = light.select("conv", "chunk").join(met, "conv").select("conv", "chunk", F.explode("met").alias("tail"))
            open_ = open_.unionByName(all_).join(pairs.select("chunk", "tail"), ["chunk", "tail"], "left_anti")
        pairs = settle(pairs.unionByName(_run_chunks(light, open_)), "vectors")


def _first_states(light: DataFrame, tails: DataFrame) -> DataFrame:
    """conv, chunk, tail, state, last: the state in which the least audit enters each chunk.

    Every chunk is traced from each state; a walk over these ends gives the states.
    """

    def ends(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for r in rows:
            vectors = viterbi.trail(r["codes"], tuple(r["tail"]))
            yield {"conv": r["conv"], "chunk": r["chunk"], "tail": r["tail"], "ends": [viterbi.trace(r["codes"], vectors, s, False)[1] for s in range(4)]}, 60

    def walk(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        held, state = None, viterbi.E
        for r in rows:
            if held is not None:
                same = held["conv"] == r["conv"]
                yield held | {"last": not same}, 60
                state = state_after if same else viterbi.E
            held = {"conv": r["conv"], "chunk": r["chunk"], "tail": r["tail"], "state": state}
            state_after = r["ends"][state]
        if held is not None:
            yield held | {"last": True}, 60

    traced = _mapped(light.join(tails.select("chunk", "tail"), "chunk").select("conv", "chunk", "codes", "tail"), "conv string, chunk long, tail array<int>, ends array<int>", ends)
    in_order = traced.repartition("conv").sortWithinPartitions("conv", "chunk")
    return settle(_mapped(in_order, "conv string, chunk long, tail array<int>, state int, last boolean", walk), "states")


def _long_pieces(chunks: DataFrame, light: DataFrame, states: DataFrame) -> DataFrame:
    """The chunks of long conversations with audit, cost and repaired rows, as :func:`_chunk` gives for the others."""
    kind = chunks.schema["conv_id"].dataType.simpleString()

    def work(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        for r in rows:
            edits, _ = viterbi.trace(r["codes"], viterbi.trail(r["codes"], tuple(r["tail"])), r["state"], r["last"])
            audit, cost, roles, texts = _edited(r["roles"], r["texts"], r["marks"], edits, r["state"])
            yield r | {"alone": False, "audit": audit, "cost": cost, "roles": roles, "texts": texts}, sum(map(len, texts))

    own = chunks.where("not alone").drop("marks", "kinds", "keys", "places", "audit", "cost", "sha", "alone", "blank", "duplicate", "truncated")
    found = own.join(light.select("chunk", "marks", "codes"), "chunk").join(states.select("chunk", "tail", "state", "last"), "chunk")
    return _mapped(found, _piece_shape(kind), work)


def _piece_shape(kind: str) -> str:
    return (
        f"conv_id {kind}, conv string, chunk long, alone boolean, marks binary, illegal long, first_role string, last_role string, "
        "first_turn long, last_turn long, n_turns long, audit string, cost long, roles array<string>, texts array<string>"
    )


def _joined(pieces: DataFrame) -> DataFrame:
    """One report per long conversation from its pieces in order. The digest runs over them one after the other, as it
    must; a task holds one batch of them at a time."""
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def work(rows: Iterator[dict]) -> Iterator[tuple[dict, int]]:
        held = None

        def leave() -> tuple[dict, int]:
            gaps = held["last_turn"] - held["from"] + 1 - held["n_turns"] if held["from"] is not None else 0
            audit = "".join(held["audit"])
            return {"conv_id": held["conv_id"], "gaps": gaps, "audit": audit, "sha": held["digest"].hexdigest(), **{c: held[c] for c in COUNTS}}, len(audit)

        for r in rows:
            if held is None or held["conv"] != r["conv"]:
                if held is not None:
                    yield leave()
                held = {"conv": r["conv"], "conv_id": r["conv_id"], "audit": [], "digest": hashlib.sha256(), "begun": False, "from": None, "last_turn": None, "n_turns": 0, "role": None} | dict.fromkeys(COUNTS, 0)
            held["begun"] = _digest(held["digest"], held["begun"], r["roles"], r["texts"])
            held["audit"].append(r["audit"])
            for name, n in _counted(bytes(r["marks"])).items():
                held[name] += n
            held["illegal"] += r["illegal"] + (held["role"] is not None and held["role"] + r["first_role"] not in LEGAL)
            held["cost"] += r["cost"]
            held["role"] = r["last_role"]
            if r["first_turn"] is not None:
                held["n_turns"] += r["n_turns"] - (r["first_turn"] == held["last_turn"])
                held["from"] = r["first_turn"] if held["from"] is None else held["from"]
                held["last_turn"] = r["last_turn"]
        if held is not None:
            yield leave()

    in_order = pieces.repartition("conv").sortWithinPartitions("conv", "chunk")
    return _mapped(in_order, _report_shape(kind), work)


def _report_shape(kind: str) -> str:
    return f"conv_id {kind}, gaps long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, sha string"


def repair(conversations: DataFrame, chunk: int = CHUNK, chunk_chars: int = CHUNK_CHARS, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Reports (one row per conversation) and the repaired rows (conv_id, chunk, place, role, text; in the order of chunk, place).

    Rows go by turn, nulls first, rows of one turn by a hash of role and text; null roles and texts are a space. A
    report holds gaps, the counts of blank, duplicate and truncated rows and of illegal neighbours, and the cost, the
    least audit and the SHA-256 of the cheapest repair, as :mod:`viterbi` defines it.

    Rows are sorted by range, so that a conversation of any length is spread over tasks, and cut into chunks of at most
    ``chunk`` rows and ``chunk_chars`` characters; a longer text is a chunk of its own. A conversation within one chunk
    is solved where it lies. The others go through speculative runs, fix-up passes and a stitched trace over their
    chunks; only chunk-sized facts are shuffled for that. Null conv_ids are one conversation. Equal rows are duplicates
    of the first. An empty table gives empty results. Other columns are not read, whatever their names. Every step is a
    written table in the shared folder.
    """
    chunks = settle(_chunks(_in_order(conversations, task_bytes), (chunk, chunk_chars)), "chunks")
    light = _without_later_copies(chunks)
    states = _first_states(light, _true_tails(light))
    pieces = settle(_long_pieces(chunks, light, states), "pieces")
    whole = chunks.where("alone").select(
        "conv_id",
        F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps"),
        *COUNTS,
        "audit",
        "sha",
    )
    parts = chunks.where("alone").select("conv_id", "chunk", "roles", "texts").unionByName(pieces.select("conv_id", "chunk", "roles", "texts"))
    rows = parts.select("conv_id", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "r")).select("conv_id", "chunk", "place", F.col("r.roles").alias("role"), F.col("r.texts").alias("text"))
    return whole.unionByName(_joined(pieces)), rows


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged as the contract says and repaired; those that lose all rows too."""
    conversations = table(spark, sf_dir, "conversations")
    reports, _ = repair(damage(conversations))
    reports = reports.withColumnRenamed("conv_id", "found_id")
    every = conversations.select("conv_id").distinct()
    nothing = F.sha2(F.lit(""), 256)
    return every.join(reports, every["conv_id"].eqNullSafe(reports["found_id"]), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", nothing).alias("repaired_sha256"),
    )


OP11_SQL = r"""
with recursive
crc as (
  select list(v order by b) as t from (
    select b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                          lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(b))
),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: unicode(x)::bigint) as bytes
  from conversations
),
faulty as (
  select conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 as k
  from keyed, crc
),
damaged as (
  select conv_id, turn, case when k = 4 then 'user' else role end as role,
         case k when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when k = 3 then [0, 1] else [0] end) as copy
  from faulty where k <> 0
),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last_char
  from damaged
),
marked as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again, left(role, 1) as kind,
         lag(left(role, 1)) over (partition by conv_id order by i) as before
  from placed
),
rows_ as (
  select *, last_char = '' as blank, last_char <> '' and again as duplicate,
         last_char <> '' and not again and last_char not in ('.', '!', '?') as truncated
  from marked
),
facts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
         count(*) filter (where truncated) as truncated,
         count(*) filter (where before is not null and before || kind not in ('su', 'ua', 'au')) as illegal
  from rows_ group by conv_id
),
back as (
  select conv_id, n + 1 as i, [0, 10, 5, 0]::bigint[] as v from facts
  union all
  select conv_id, i, [least(e, 5 + least(u, 5 + a)), least(s, 5 + least(u, 5 + a)), least(u, 5 + a), least(a, 5 + u)] from (
    select r.conv_id, r.i,
           case when gone then 2 + v[1] else least(2 + v[1], late + v[3] + (case kind when 'u' then 0 else 1 end),
                case kind when 's' then late + v[2] else 1000000000 end) end as e,
           case when gone then 2 + v[2] else least(2 + v[2], late + v[3] + (case kind when 'u' then 0 else 1 end)) end as s,
           case when gone then 2 + v[3] else least(2 + v[3], late + v[4] + (case kind when 'a' then 0 else 1 end)) end as u,
           case when gone then 2 + v[4] else least(2 + v[4], late + v[3] + (case kind when 'u' then 0 else 1 end)) end as a
    from back b join (select *, blank or duplicate as gone, case when truncated then 5 else 0 end as late from rows_) r
      on r.conv_id is not distinct from b.conv_id and r.i = b.i - 1)
),
steps as (
  select b.conv_id, b.i, b.v as here, c.v as after, r.kind, r.role, r.text, case when r.truncated then 5 else 0 end as late
  from back b
  left join back c on c.conv_id is not distinct from b.conv_id and c.i = b.i + 1
  left join rows_ r on r.conv_id is not distinct from b.conv_id and r.i = b.i
),
walk as (
  select conv_id, 1::bigint as i, 1 as state, '' as audit, []::varchar[] as lines from facts
  union all
  select conv_id, case letter when 'I' then i else i + 1 end, case letter when 'D' then state when 'S' then 2 else follow end,
         audit || case letter when 'S' then 'K' else letter end,
         case letter when 'D' then lines
                     when 'I' then list_append(lines, case follow when 3 then 'user:' else 'assistant:' end)
                     when 'R' then list_append(lines, case follow when 3 then 'user:' else 'assistant:' end || text)
                     else list_append(lines, role || ':' || text) end
  from (
    select w.*, [3, 3, 4, 3][state] as follow, s.role, s.text,
           case when after is null then 'I'
                when here[state] = 2 + after[state] then 'D'
                when here[state] = 5 + here[[3, 3, 4, 3][state]] then 'I'
                when kind = 's' and state = 1 and here[state] = late + after[2] then 'S'
                when kind = case state when 3 then 'a' else 'u' end then 'K' else 'R' end as letter
    from walk w join steps s on s.conv_id is not distinct from w.conv_id and s.i = w.i
    where after is not null or state in (2, 3))
),
ended as (
  select conv_id, arg_max(audit, length(audit)) as audit, arg_max(lines, length(audit)) as lines from walk group by conv_id
),
costs as (select conv_id, v[1] as cost from back where i = 1),
every as (select distinct conv_id from conversations)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from every e
left join facts f on f.conv_id is not distinct from e.conv_id
left join costs c on c.conv_id is not distinct from e.conv_id
left join ended d on d.conv_id is not distinct from e.conv_id
"""
