"""Personal data in texts: exact base patterns, and boosted trees over looser candidates. DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm.common import settle, table, text_of

#: The kinds in their order, and the base patterns. Possessive quantifiers and the look-behind keep the
#: leftmost matches as they are and long runs linear; without them the patterns are those of the contract.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Generators of candidates: other marks between the parts, no sign of a country, spelled signs.
LOOSE = {
    "email": r"[^\s@<>|\"']{1,64}+(?: ?[(\[](?:at|AT)[)\]] ?|@)[^\s@<>|\"']{1,64}+",
    "ip": r"[0-9]{1,3}(?:[.,:] ?[0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}",
    "card": r"[0-9](?:[ ./-]{0,2}[0-9]){11,18}",
    "phone": r"(?:\+|00)?[(]?[0-9]{2,4}[) ./-]{1,2}[0-9]{3,4}[ ./-][0-9]{3,4}",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@|[(\\[](?:at|AT)[)\\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
CUES = "(?i)(?:mail|contact|write|tel|phone|fax|call|mobile|card|visa|pay|account|iban|ip|host|server|addr)[a-z]*[^a-z]{0,6}$"
#: Features of a candidate with the number of values each can have; their product bounds the table that is fitted.
FEATURES = {"kind": 4, "digits": 8, "letters": 2, "marks": 5, "before": 4, "after": 4, "cue": 2, "even": 2, "length": 6}
ROUNDS, RATE, PRECISION = 40, 0.3, 0.95


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body or a function inside it uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(lengths: Column) -> Column:
    """What stands before each element of an array of numbers; in blocks, so that long arrays do not cost their square."""
    zero = F.array(F.lit(0).cast("long"))
    grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))

    def blocks(all_: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(all_) - 1) / 256).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.aggregate(F.slice(all_, b * 256 + 1, F.lit(256)), zero, grow))

    def joined(inner: Column, base: Column) -> Column:
        shifted = lambda x, i: let(F.element_at(base, i + 1), lambda b: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda v: v + b))
        return F.flatten(F.transform(inner, shifted))

    totals = lambda inner: F.aggregate(inner, zero, lambda acc, x: grow(acc, F.element_at(x, -1)))
    return let(let(lengths, blocks), lambda inner: let(totals(inner), lambda base: joined(inner, base)))


def found(df: DataFrame, name: str, pattern: str, needs: str) -> DataFrame:
    """df with an array ``name`` of the pattern's matches: start, end (code points), value, before, after."""
    text, none = F.col("text"), F.array().cast("array<string>")
    due = text.rlike(needs)
    df = df.withColumn("_values", F.when(due, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_gaps", F.when(F.size("_values") > 0, F.split("text", pattern, -1)).otherwise(none))
    df = df.withColumn(
        "_at", running(F.zip_with(F.slice("_gaps", F.lit(1), F.size("_values")), "_values", lambda g, v: (F.length(g) + F.length(v)).cast("long")))
    )

    def one(value: Column, i: Column) -> Column:
        gap, after = F.get("_gaps", i), F.get("_gaps", i + 1)
        start = F.get("_at", i) + F.length(gap)
        return F.struct(
            start.alias("start"),
            (start + F.length(value)).alias("end"),
            value.alias("value"),
            F.right(gap, F.lit(24)).alias("before"),
            F.left(after, F.lit(1)).alias("after"),
        )

    return df.withColumn(name, F.transform("_values", one)).drop("_values", "_gaps", "_at")


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str) -> Callable[[Column], Column]:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    n = lambda m: F.length(digits_of(m["value"]))
    return {
        "email": lambda m: F.lit(True),
        "ip": lambda m: m["value"].rlike(rf"^{part}(?:\.{part}){{3}}$"),
        "card": lambda m: n(m).between(12, 19) & F.call_function("luhn_check", digits_of(m["value"])),
        "phone": lambda m: n(m).between(9, 15),
    }[kind]


def _class(char: Column) -> Column:
    return F.when(char.isNull() | (char == ""), 0).when(char.rlike("\\s"), 1).when(char.rlike("[\\p{L}\\p{N}]"), 2).otherwise(3)


def _features(kind: str, m: Column, n: Column, rest: Column) -> dict[str, Column]:
    """Small whole numbers that describe a candidate's format and its neighbours; n digits, rest: its marks."""
    value = m["value"]
    only = lambda s: rest.rlike(f"^{s}*$")
    edges = (8, 10, 12, 13, 14, 16, 17)
    sizes = (8, 12, 16, 20, 28)
    return {
        "kind": F.lit(KINDS.index(kind)),
        "digits": sum(((n >= e).cast("int") for e in edges), F.lit(0)),
        "letters": value.rlike("[A-Za-z]").cast("int"),
        "marks": F.when(rest == "", 0).when(only("[.@]"), 1).when(only(" "), 2).when(only("[-()+ ]"), 3).otherwise(4),
        "before": _class(F.right(m["before"], F.lit(1))),
        "after": _class(m["after"]),
        "cue": m["before"].rlike(CUES).cast("int"),
        "even": (n % 4 == 0).cast("int"),
        "length": sum(((F.length(value) >= e).cast("int") for e in sizes), F.lit(0)),
    }


def _span(k: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"))


def _described(k: int) -> Callable[[Column], Column]:
    def one(m: Column) -> Column:
        sure = F.exists(f"_own{k}", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
        counted = F.struct(F.length(digits_of(m["value"])).alias("n"), F.regexp_replace(m["value"], "[0-9A-Za-z]", "").alias("rest"))

        def numbers(c: Column) -> Column:
            named = [x.cast("int").alias(n) for n, x in _features(KINDS[k], m, c["n"], c["rest"]).items()]
            return F.struct(m["start"].alias("start"), m["end"].alias("end"), sure.alias("sure"), *named)

        return let(counted, numbers)

    return one


def _of_kind(k: int) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == k


def candidates(docs: DataFrame) -> DataFrame:
    """docs without text, with ``base`` (kind number, start, end) and ``loose`` (start, end, features, sure).

    A candidate is sure where a base span of its kind overlaps it.
    """
    df = docs
    for k, kind in enumerate(KINDS):
        df = found(df, "_hits", BASE[kind], NEEDS[kind])
        df = df.withColumn(f"_own{k}", F.transform(F.filter("_hits", _valid(kind)), _span(k))).drop("_hits")
        df = found(df, "_hits", LOOSE[kind], NEEDS[kind])
        df = df.withColumn(f"_loose{k}", F.transform("_hits", _described(k))).drop("_hits")
    own, loose = ([F.col(f"{name}{k}") for k in range(len(KINDS))] for name in ("_own", "_loose"))
    return df.select("doc_id", "fold", F.array_sort(F.concat(*own)).alias("base"), F.concat(*loose).alias("loose"))


Tree = tuple  # (feature, at, left, right) with leaves as numbers: left where the feature is under ``at``


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _split(rows: list, depth: int) -> Tree | float:
    """The Newton tree of the rows (features, gradient, curvature)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = None
    if depth:
        for name in FEATURES:
            by: dict[int, list[float]] = {}
            for x, a, b in rows:
                s = by.setdefault(x[name], [0.0, 0.0])
                s[0] += a
                s[1] += b
            left_g = left_h = 0.0
            values = sorted(by)
            for value, following in zip(values[:-1], values[1:], strict=True):
                left_g, left_h = left_g + by[value][0], left_h + by[value][1]
                gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, name, following)
    if best is None:
        return RATE * g / (h + 1)
    _, name, at = best
    return (name, at, *(_split([r for r in rows if (r[0][name] < at) == side], depth - 1) for side in (True, False)))


def _value(tree: Tree | float, x: dict) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] < tree[1] else tree[3]
    return tree


def boost(rows: list[tuple[dict, float, float]], rounds: int = ROUNDS, depth: int = 3) -> tuple[float, list]:
    """Boosted trees for rows (features, sure ones, others): the first score and the trees of the log odds."""
    yes, no = sum(r[1] for r in rows), sum(r[2] for r in rows)
    first, trees = _logit((yes + 1) / (yes + no + 2)), []
    scores = [first] * len(rows)
    for _ in range(rounds if yes and no else 0):
        state = []
        for (x, a, b), s in zip(rows, scores, strict=True):
            p = 1 / (1 + math.exp(-s))
            state.append((x, a * (1 - p) - b * p, (a + b) * p * (1 - p)))
        tree = _split(state, depth)
        trees.append(tree)
        scores = [s + _value(tree, x) for (x, _, _), s in zip(rows, scores, strict=True)]
    return first, trees


def threshold(rows: list[tuple[dict, float, float]], first: float, trees: list, precision: float) -> float:
    """The least score from which on the share of sure candidates stays at ``precision`` or more; inf where none does."""
    scored = sorted(((first + sum(_value(t, x) for t in trees), a, b) for x, a, b in rows), key=lambda r: -r[0])
    yes = all_ = 0.0
    cut, i = math.inf, 0
    while i < len(scored):
        score = scored[i][0]
        while i < len(scored) and scored[i][0] == score:
            yes, all_, i = yes + scored[i][1], all_ + scored[i][1] + scored[i][2], i + 1
        # one more miss than seen keeps a few lucky candidates from setting the threshold
        if yes / (all_ + 1) < precision:
            break
        cut = score
    return cut


def _column(tree: Tree | float, m: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(m[tree[0]] < tree[1], _column(tree[2], m)).otherwise(_column(tree[3], m))


def find_personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end) in that order; kind is its place in ``KINDS``.

    Base spans are the leftmost matches of the base patterns that pass their check. Loose patterns propose further spans,
    described by small numbers. Boosted trees learn from all candidates of three in four documents which descriptions go
    with base spans; on the fourth the least score is found at which ``precision`` of the candidates are base spans.
    Candidates from there on that overlap no base span of their kind are added.
    The trees see one row per description, at most the product of ``FEATURES``, whatever the number of documents.

    Null texts are empty and hold nothing. Repeated rows are searched each. An empty table gives no rows. Only doc_id
    and text are read, so other columns may have any name.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.crc32(text_of().cast("binary")).alias("fold"))
    rows = settle(candidates(rows), "pii-candidates")
    described = rows.select((F.col("fold") % 4 == 0).alias("held"), F.explode("loose").alias("m")).select("held", "m.*")
    counted = described.groupBy("held", *FEATURES).agg(
        F.sum(F.col("sure").cast("int")).alias("yes"), F.sum((~F.col("sure")).cast("int")).alias("no")
    )
    cube = sorted(counted.collect(), key=lambda r: tuple(r))
    parts = {held: [({n: r[n] for n in FEATURES}, float(r["yes"]), float(r["no"])) for r in cube if r["held"] == held] for held in (False, True)}
    first, trees = boost(parts[False])
    cut = threshold(parts[True], first, trees, precision)
    if math.isinf(cut):
        added = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    else:
        chosen = F.filter("loose", lambda m: ~m["sure"] & (sum((_column(t, m) for t in trees), F.lit(first)) >= cut - 1e-9))
        added = F.transform(chosen, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    spans = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))
