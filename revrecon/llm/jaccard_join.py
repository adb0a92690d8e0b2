"""Near copies by the Jaccard similarity of word n-grams: a chosen-path join, then an exact check of what it groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm.common import held, settle, slices, spans, table, text_of
from revrecon.llm.components import components, local_roots

WORDS, SIMILARITY = 5, 0.8
#: Runs and levels of paths. A pair at similarity s meets in one run with probability s**LEVELS at least, so at 0.8 it
#: is missed by all runs with probability (1 - 0.8**4)**16 = 0.0002.
RUNS, LEVELS = 16, 4
#: A bucket up to this size is compared at once; larger ones are split by the next token of their path.
SMALL = 64
#: Buckets that are larger after the last level are dealt into lots of half this size, and each two lots are compared.
LOT = 8192
#: Sets in one tile of the exact check, columns of a matrix in it, and rows of the tile that are compared at one time.
TILE, COLUMNS, ROWS = 1024, 1024, 256
#: Words whose hashes a worker keeps.
KEPT_WORDS = 100_000
#: Pairs whose sketches agree less than this are not pursued: five deviations under the similarity.
SKETCH_CUT = 0.55
FUNCTIONS = RUNS * LEVELS
NO_ID = np.iinfo(np.int64).min

_RNG = np.random.default_rng(20_11)
_FACTOR = _RNG.integers(1, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64)
_POWERS = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingles(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams; a shorter text is one n-gram, one without words none."""
    split = [t.split() for t in texts]
    hashes = held("words")
    if len(hashes) > KEPT_WORDS:
        hashes.clear()
    for w in set().union(*split).difference(hashes):
        hashes[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    out = []
    for ws in split:
        h = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws))
        n = min(words, len(h))
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        grams = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            grams += h[k : k + len(grams)] * np.uint64(_POWERS[k + 1])
        out.append(np.unique(_mixed(grams)))
    return out


def signature(grams: np.ndarray) -> np.ndarray:
    """For each hash function the least value over the set: the token that a path takes there."""
    best = np.full(FUNCTIONS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(grams), 2048):
        values = grams[None, lo : lo + 2048] * _FACTOR[:, None] + _SHIFT[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(">u4")


def document_sets(docs: DataFrame, words: int) -> DataFrame:
    """key, content, set_id, n, signature for every row; set_id is null for texts without words."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, "text"):
            sets = shingles(pdf["text"].tolist(), words)
            yield pd.DataFrame(
                {
                    "key": pdf["key"],
                    "content": pdf["content"],
                    "set_id": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "signature": [signature(s).tobytes() if len(s) else None for s in sets],
                }
            )

    return keyed(docs).mapInPandas(work, "key long, content long, set_id binary, signature binary")


def keyed(docs: DataFrame) -> DataFrame:
    """key (doc_id, the least number for null), content (a hash of the text), text."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return docs.select(key.alias("key"), F.xxhash64(text_of()).alias("content"), text_of().alias("text"))


def leaf_buckets(sets: DataFrame) -> DataFrame:
    """bucket, set_id: the leaves of all runs' paths that hold two sets or more.

    A run follows one path per set: at each level the set's least token under the level's hash. Sets that took the same
    tokens so far share a bucket; buckets of over ``SMALL`` sets go to the next level. After the last level a bucket of
    over ``LOT`` sets is given out as a bucket for each two of its lots, so all its pairs still meet.
    """
    runs = F.explode(F.sequence(F.lit(0), F.lit(RUNS - 1)))
    active = sets.select("set_id", "signature", runs.alias("run"))
    path = F.substring("signature", F.col("run") * 4 * LEVELS + 1, F.lit(4 * LEVELS))
    active, leaves = active.select("set_id", F.col("run").cast("byte").alias("run"), path.alias("path")), []
    for level in range(1, LEVELS + 1):
        at = F.substring("path", 1, 4 * level)
        sized = active.groupBy("run", at.alias("at")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        joined = settle(active.withColumn("at", at).join(sized, ["run", "at"]), "paths")
        done = joined if level == LEVELS else joined.where(F.col("n") <= SMALL)
        fits = done if level < LEVELS else done.where(F.col("n") <= LOT)
        leaves.append(fits.select(F.xxhash64(F.lit(level), "run", "at").alias("bucket"), "set_id"))
        active = joined.where(F.col("n") > SMALL).select("set_id", "run", "path")
    lots = F.ceil(F.col("n") / max(1, LOT // 2)).cast("int")
    large = joined.where(F.col("n") > LOT).withColumn("lots", lots).withColumn("own", F.pmod(F.xxhash64("set_id", "run"), "lots").cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).where("own <> other")
    leaves.append(large.select(F.xxhash64(F.lit(LEVELS), "run", "at", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "set_id"))
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def complete_groups(batches: Iterator[pd.DataFrame], key: str, most: int = 20_000) -> Iterator[pd.DataFrame]:
    """Sorted rows in lots that never cut a group of equal keys."""
    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if len(pdf):
            rest.append(pdf)
            if sum(map(len, rest)) >= most or len(rest) > 50:
                all_ = pd.concat(rest, ignore_index=True)
                keys = all_[key].to_numpy()
                cut = int(np.searchsorted(keys == keys[-1], True)) if keys[0] != keys[-1] else 0
                if cut:
                    yield all_.iloc[:cut].reset_index(drop=True)
                rest = [all_.iloc[cut:]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def bucket_links(sketches: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links i-j inside buckets that connect all pairs whose sketches agree enough.

    Small buckets compare every pair. In larger ones each set in turn meets those that no link has reached yet.
    """
    need, width = SKETCH_CUT + (1 - SKETCH_CUT) / 256, sketches.shape[1]
    left, right = [], []
    runs = spans(buckets)
    small = np.zeros(len(buckets), bool)
    longest = 1
    for lo, hi in runs:
        if hi - lo <= SMALL:
            small[lo:hi] = True
            longest = max(longest, hi - lo)
    for step in range(1, longest):
        i = np.flatnonzero((buckets[:-step] == buckets[step:]) & small[:-step])
        if len(i):
            near = (sketches[i] == sketches[i + step]).sum(axis=1) >= need * width
            left.append(i[near])
            right.append(i[near] + step)
    for lo, hi in runs:
        if hi - lo > SMALL:
            waiting = np.arange(lo, hi)
            while len(waiting):
                reached, waiting = [int(waiting[0])], waiting[1:]
                while reached and len(waiting):
                    one = reached.pop()
                    near = (sketches[waiting] == sketches[one]).sum(axis=1) >= need * width
                    if near.any():
                        met = waiting[near]
                        left.append(np.full(len(met), one))
                        right.append(met)
                        reached += met.tolist()
                        waiting = waiting[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def candidate_links(sets: DataFrame) -> DataFrame:
    """a, b: links between sets whose sketches agree, at least one per set and bucket; their components hold all pairs found."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held("links")
        for pdf in complete_groups(batches, "bucket"):
            sketches = np.frombuffer(b"".join(pdf["signature"]), np.uint8).reshape(len(pdf), -1)[:, 3::4]
            i, j = bucket_links(sketches, pdf["bucket"].to_numpy())
            roots = local_roots(len(pdf), i, j)
            own = np.flatnonzero(roots != np.arange(len(pdf)))
            ids = pdf["set_id"].to_numpy()
            yield pd.DataFrame({"a": ids[own], "b": ids[roots[own]]}).drop_duplicates()

    rows = leaf_buckets(sets).join(sets.select("set_id", "signature"), "set_id")
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(work, "a binary, b binary")


def similar_pairs(sets: list[np.ndarray], side: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets at ``similarity`` or more, counted exactly; with two sides only pairs across them."""
    n = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(len(sets)), n.astype(np.int64))
    _, column, uses = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        common += part @ part.T
    left, right, across = [], [], side.any() and not side.all()
    for lo in range(0, len(sets), ROWS):
        part, rows = common[lo : lo + ROWS], np.arange(lo, min(lo + ROWS, len(sets)))
        alike = part >= similarity * (n[rows, None] + n[None, :] - part) - 1e-6
        if across:
            alike &= side[rows, None] != side[None, :]
        i, j = np.nonzero(np.triu(alike, lo + 1))
        left.append(i + lo)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def exact_links(docs: DataFrame, reps: DataFrame, groups: DataFrame, words: int, similarity: float) -> DataFrame:
    """set_id, links, lead: for each set of a candidate component and tile the documents linked to it, and a set that it
    hangs together with. Components are checked in full, tile against tile, so no link inside one is lost."""
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    members = groups.join(sizes, "root").join(reps.select("set_id", "copies", "one"), groups["node"] == reps["set_id"])
    members = members.select("root", "tiles", "set_id", "copies", F.col("one.key").alias("k"), F.col("one.content").alias("c"))

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(batches, "text"):
            grams = shingles(pdf["text"].tolist(), words)
            yield pdf.drop(columns="text").assign(grams=[g.astype("<u8").tobytes() for g in grams])

    texts = keyed(docs)
    found = texts.join(members, (texts["key"] == F.col("k")) & (texts["content"] == F.col("c"))).dropDuplicates(["set_id"])
    found = found.select("root", "tiles", "set_id", "copies", "text")
    grams = found.mapInPandas(sets_of, "root binary, tiles int, set_id binary, copies long, grams binary")
    own = F.pmod(F.xxhash64("set_id"), F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiled = grams.withColumn("own", own).withColumn("other", other)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    tiled = tiled.select(F.xxhash64("root", low, high).alias("tile"), (F.col("own") == low).alias("lower"), "root", "set_id", "copies", "grams")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held("links")
        for pdf in complete_groups(batches, "tile", 2000):
            for lo, hi in spans(pdf["tile"].to_numpy()):
                part = pdf.iloc[lo:hi]
                sets = [np.frombuffer(g, "<u8") for g in part["grams"]]
                i, j = similar_pairs(sets, part["lower"].to_numpy(bool), similarity)
                copies, ids = part["copies"].to_numpy(np.float64), part["set_id"].to_numpy()
                links = np.bincount(i, copies[j], len(sets)) + np.bincount(j, copies[i], len(sets))
                roots = local_roots(len(sets), i, j)
                yield pd.DataFrame({"set_id": ids, "links": links.astype(np.int64), "lead": ids[roots]})

    dealt = tiled.repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInPandas(check, "set_id binary, links long, lead binary")


def near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, key, content, set_id, n_links (rows linked to this one) and class_id (the least doc_id that links reach).

    Rows are linked where the Jaccard similarity of their sets of word n-grams is at least ``similarity``; equal sets are
    one set with a number of copies throughout, so a group of copies costs one row. A shorter text is one n-gram.
    Sets meet in buckets of a chosen-path join (see ``leaf_buckets``), where sketches of 64 bytes propose links; the
    components of these are then checked in full on the n-grams, so every link is exact and only pairs that no run
    brings together, directly or through others, can be missed (two in ten thousand at a similarity of 0.8).

    Texts without words (null, empty, blank) link with nothing and are their own class. A null doc_id counts for class_id
    only where its class has no other. Repeated rows are copies of each other. An empty table gives no rows. Only doc_id
    and text are read, so other columns may have any name.
    """
    rows = settle(document_sets(docs, words), "sets")
    one = F.struct(F.col("key").alias("key"), F.col("content").alias("content"))
    least = F.min(F.when(F.col("key") != NO_ID, F.col("key")))
    known = rows.where(F.col("set_id").isNotNull()).groupBy("set_id")
    reps = settle(known.agg(F.count(F.lit(1)).alias("copies"), least.alias("least"), F.min(one).alias("one"), F.first("signature").alias("signature")), "reps")
    groups = settle(components(candidate_links(reps.select("set_id", "signature"))), "groups")
    links = settle(exact_links(docs, reps, groups, words, similarity), "exact-links")
    classes = components(links.select(F.col("set_id").alias("a"), F.col("lead").alias("b")))
    counted = links.groupBy("set_id").agg(F.sum("links").alias("links"))
    full = reps.select("set_id", "copies", "least").join(counted, "set_id", "left").join(classes, F.col("set_id") == F.col("node"), "left")
    full = settle(full.select("set_id", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "set_id").alias("root")), "classes")
    class_of = full.groupBy("root").agg(F.min("least").alias("class_id"))
    sets = full.join(class_of, "root").select(F.col("set_id").alias("s"), (F.col("links") + F.col("copies") - 1).alias("n_links"), "class_id", "root")
    joined = rows.drop("signature").join(sets, F.col("set_id") == F.col("s"), "left").drop("s")
    doc_id = F.when(F.col("key") != NO_ID, F.col("key"))
    alone = F.col("set_id").isNull()
    return joined.select(
        doc_id.alias("doc_id"),
        "key",
        "content",
        "root",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, doc_id).otherwise(F.col("class_id")).alias("class_id"),
    )


def without_near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one with the least doc_id; texts without words all stay, repeated or not.

    Of rows equal in doc_id and text one stays, whichever other columns they have. A null doc_id comes after all others;
    among several rows of the least doc_id the text with the least hash stays. Texts of any length are compared whole. An
    empty table gives no rows. The columns stay as they are and may have any name, as the documents are held in one struct
    while they are joined.
    """
    found = near_copies(docs, words, similarity)
    kept = found.where(F.col("root").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id")))
    alone = kept.where(F.col("root").isNull()).select("key", "content").distinct()
    one = kept.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct("key", "content")).alias("o")).select("o.*")
    chosen = alone.withColumn("all", F.lit(True)).union(one.withColumn("all", F.lit(False)))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    held = docs.select(key.alias("key"), F.xxhash64(text_of()).alias("content"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    joined = held.join(chosen, ["key", "content"])
    # rows equal in doc_id and text: one stays
    repeated = joined.where(~F.col("all")).dropDuplicates(["key", "content"])
    return joined.where("all").select("doc.*").union(repeated.select("doc.*"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents."""
    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", "n_links", "class_id")
