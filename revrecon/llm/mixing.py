"""Mixing sources to target weights with hash thresholds, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revrecon.llm.common import BLANK, settle, table, text_of

WEIGHTS = (5, 2, 1)
#: A source is taken this many times at most.
MOST = 3
#: Bits of the hash that one histogram divides; the hash has HASH_BITS of them.
STEP, HASH_BITS = 10, 60
KEYS = ("hash", "content", "row")
CUTS = [f"cut_{k}" for k in KEYS]


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: the total shared by weight, no target above ``most`` times its source.

    Sources go by code point, null last, and take the weights in turn. Where a share is above its limit, the source
    gets the limit and the rest is shared anew; sources by rising limit per weight are passed once for that. One row
    per source goes through the two windows that have no partition.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighted = total.withColumn("weight", F.element_at(cycle, turn.cast("int")))
    limit = most * F.col("source_size").cast("double")
    by_limit = Window.orderBy(limit / F.col("weight"), F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = weighted.withColumn("level", left / weight_left).withColumn("held", limit <= F.col("level") * F.col("weight"))
    free = F.max(F.when(~F.col("held"), F.col("level"))).over(everything)
    target = F.when(F.col("held"), limit).otherwise(free * F.col("weight"))
    return level.withColumn("target", target).select("source", "source_size", "target")


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with mix_size and three hashes: of the doc_id, of the text, and of the row's place, which is asked only
    where rows are equal in both."""
    text, doc_id = text_of(), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hashed = F.conv(F.substring(F.md5(doc_id), 1, HASH_BITS // 4), 16, 10).cast("long")
    content, row = (F.shiftrightunsigned(F.xxhash64(c), 64 - HASH_BITS) for c in (text, F.monotonically_increasing_id()))
    size = F.regexp_count(text, F.lit(f"[^{BLANK}]+")).cast("long")
    return docs.withColumns({"mix_size": size, "mix_hash": hashed, "mix_content": content, "mix_row": row})


def thresholds(targets: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """targets with rounds (whole copies of the source), and a cut where a part of a copy is due: documents under
    (cut_hash, cut_content, cut_row) are in it, and the one that is there if cut_in. Parts that are not needed to tell
    that one from the others are null."""
    whole = F.least(F.expr("cast(round(target) as bigint) div source_size"), F.lit(most))
    budgets = targets.withColumn("rounds", F.when(F.col("source_size") > 0, whole).otherwise(0).cast("long")).withColumn(
        "rest", F.round("target").cast("long") - F.col("rounds") * F.col("source_size")
    )
    budgets = settle(budgets, "mix-budgets")
    state = budgets.where(F.col("rest") > 0).select("source", "rest")
    edge = sizes.select("source", "size", *KEYS)
    levels = [(key, left) for key in KEYS for left in range(HASH_BITS - STEP, -1, -STEP)]
    for key, left in levels:
        counted = (
            edge.join(state.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source", "rest", F.shiftright(key, left).alias("bucket"))
            .agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"))
        )
        up_to = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        ends = counted.withColumn("up_to", up_to).where(F.col("up_to") >= F.col("rest"))
        first = F.min_by(F.struct("bucket", (F.col("rest") - F.col("up_to") + F.col("n")).alias("rest"), "rows"), "bucket")
        state = settle(ends.groupBy("source").agg(first.alias("b")).select("source", "b.*"), "mix-state")
        same = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright(key, left) == F.col("bucket"))
        edge = settle(edge.join(state.select(F.col("source").alias("s"), "bucket"), same).select(edge["*"]), "mix-edge")
        if (state.agg(F.max("rows")).first()[0] or 1) == 1:
            break
    needed = KEYS[: KEYS.index(key) + 1]
    one = [(F.min(k) if k in needed else F.lit(None).cast("long")).alias(f"cut_{k}") for k in KEYS]
    at = edge.groupBy("source").agg(*one, F.sum("size").alias("n"))
    cuts = at.alias("a").join(state.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    cuts = cuts.select(F.col("a.source").alias("s"), *CUTS, (2 * F.col("rest") >= F.col("n")).alias("cut_in"))
    joined = budgets.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    return settle(joined.select("source", "source_size", "target", "rounds", *CUTS, "cut_in"), "mix-cuts")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, narrow: bool = False) -> DataFrame:
    """The documents with mix_size, mix_source_size, mix_target and mix_copies; ``narrow`` leaves out the texts.

    Each document has a hash. A source's target is filled by nested thresholds: copy number c takes the documents whose
    hash is under the threshold of what is left after c - 1 whole rounds, so all but one threshold are 'all' or 'none'.
    That one is found from histograms: sizes are summed by source and hash bucket, and only the bucket in which the
    target ends is refined by the next bits, until it holds one document, which is taken where that comes nearer to the
    target. Nothing is sorted, and a source of any length is spread over all tasks.

    Null and empty texts have size 0. A null source is a source, the last one. Rows with the same hash are told apart by
    a second hash. An empty table gives no rows. Other columns may have any name but those that are added.
    """
    rows = keyed(docs)
    columns = {"doc_id": F.col("doc_id").cast("long"), "source": F.col("source").cast("string")}
    sizes = settle(
        rows.select(*[c.alias(n) for n, c in columns.items()], *[F.col(f"mix_{n}").alias(n) for n in ("size", *KEYS)]), "mix-sizes"
    )
    cuts = thresholds(source_targets(sizes, weights, most), sizes, most)
    if narrow:
        rows = sizes.select("doc_id", "source", *[F.col(n).alias(f"mix_{n}") for n in ("size", *KEYS)])
    cuts = cuts.select(*[F.col(n).alias(f"mix_{n}") for n in cuts.columns])
    part = F.col("mix_cut_in")
    for k in reversed(KEYS):
        own, cut = F.col(f"mix_{k}"), F.col(f"mix_cut_{k}")
        part = F.when(cut.isNull(), part).otherwise((own < cut) | ((own == cut) & part))
    copies = F.col("mix_rounds") + F.when(F.col("mix_cut_hash").isNotNull() & part, 1).otherwise(0)
    joined = rows.join(cuts, rows["source"].cast("string").eqNullSafe(F.col("mix_source"))).withColumn("mix_copies", copies)
    return joined.select(*rows.columns, "mix_source_size", "mix_target", "mix_copies").drop(*[f"mix_{k}" for k in KEYS])


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each document as often as the mix takes it."""
    taken = mixed.where(F.col("mix_copies") > 0)
    return taken.withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).select(*columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed 5 : 2 : 1 over their sources."""
    return mix(table(spark, sf_dir, "documents"), narrow=True).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


OP1_SQL = """
with d as (
 select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
  substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15) as h from documents),
s as (
 select source, cast(sum(size) as bigint) as source_size,
  cast([5, 2, 1][1 + (row_number() over (order by source is null, source) - 1) % 3] as double) as weight from d group by source),
v as (
 select *, 3.0::double * source_size as lim,
  (sum(cast(source_size as double)) over () - coalesce(sum(3.0::double * source_size) over b, 0))
   / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
 from s window b as (order by 3.0::double * source_size / weight, source is null, source rows between unbounded preceding and 1 preceding)),
t as (
 select source, source_size, case when lim <= level * weight then lim else weight * max(case when lim > level * weight then level end) over () end as target from v),
r as (
 select *, case when source_size > 0 then least(cast(round(target) as bigint) // source_size, 3) else 0 end as rounds from t),
c as (
 select d.doc_id, d.size, r.source_size, r.target, r.rounds, cast(round(r.target) as bigint) - r.rounds * r.source_size as rest,
  sum(d.size) over (partition by d.source order by d.h rows between unbounded preceding and current row) - d.size as before
 from d join r on d.source is not distinct from r.source),
f as (
 select *, max(case when before < rest then before end) over (partition by source_size, target, rounds, rest) as last_before from c)
select doc_id, size, source_size, target,
 cast(size * (rounds + case when rest > 0 and (before + size < rest or before < rest and 2 * (rest - before) >= size) then 1 else 0 end) as bigint) as taken
from c
"""
