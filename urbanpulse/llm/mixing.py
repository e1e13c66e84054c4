"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a fixed pseudo-random order, are cut into blocks of
``block_chars`` characters.  Block j of a source with weight w may be placed from
its release time floor(j / w) on and must be placed before its deadline
ceil((j + 1) / w).  One block is placed per slot: of the released blocks the one
with the earliest deadline.  As the weights sum to 1, every block meets its
deadline, so at any slot t a source has had w * t blocks, less than one more or
less.

Weights are whole shares of ``slots`` (largest remainders, one at least), so the
schedule repeats every ``slots`` slots, and one period is all that is ever simulated
(``slots`` is a bounded parameter).  The place of any block follows by division:
no row waits for another.

Row numbers and running sizes per source are taken in two levels: within
(source, hash bucket), and over the sums of the buckets.  The number of buckets
follows the number of rows, so a hot source is split like any other.

No row is dropped: equal rows are planned once, with their number, and numbered at the end.  ``in_mix`` is true up to the first slot that a source cannot
fill; behind it the remaining sources go on in the proportions of their weights.

Sources without a weight of their own, and null sources, share the weight of
``OTHER``.  Nulls and empty texts have no characters.  Rows equal in id, text and
source of the weights follow one another.  Ties of the order (a hash of id and text) are ordered by id and text hash.  An empty table
gives an empty result.  Extra columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, seal, text_hash, whole_text

OTHER = "*"
SLOTS = 100
BLOCK_CHARS = 65_536
ROWS_PER_BUCKET = 2_500
COPIES_AT_ONCE = 4_096
#: Target weights of the production mix.
WEIGHTS = {"src0": 0.20, **{f"src{k}": 0.05 for k in range(1, 10)},
           **{f"src{k}": 0.03 for k in range(10, 20)}, OTHER: 0.05}


def shares(weights: dict[str, float], slots: int = SLOTS) -> dict[str, int]:
    """Slots per period of each source: largest remainders, one at least."""
    if OTHER not in weights or min(weights.values()) <= 0 or len(weights) > slots <= 100_000:
        raise ValueError(f"weights must be positive, include {OTHER!r} and be no more than slots")
    total = sum(weights.values())
    exact = {s: w / total * slots for s, w in weights.items()}
    out = {s: max(1, math.floor(x + 1e-9)) for s, x in exact.items()}
    while sum(out.values()) != slots:
        lack = slots - sum(out.values())
        step = 1 if lack > 0 else -1
        free = [s for s in out if step > 0 or out[s] > 1]
        out[max(free, key=lambda s: step * (exact[s] - out[s]))] += step
    return out


def period(share: dict[str, int]) -> list[tuple[str, int]]:
    """(source, block of the period) per slot: earliest deadline first among released blocks."""
    slots = sum(share.values())
    done = dict.fromkeys(share, 0)
    out = []
    for t in range(slots):
        ready = [(-(-(done[s] + 1) * slots // a), k, s) for k, (s, a) in enumerate(share.items())
                 if done[s] < a and done[s] * slots // a <= t]
        _, _, s = min(ready)
        out.append((s, done[s]))
        done[s] += 1
    return out


def _mix_source(share: dict[str, int], source_col: str) -> Column:
    """The source of the weights that a row counts for."""
    named = [s for s in share if s != OTHER]
    source = F.col(source_col).cast("string")
    return F.when(source.isin(named), source).otherwise(F.lit(OTHER)) if named else F.lit(OTHER)


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source", slots: int = SLOTS,
             block_chars: int = BLOCK_CHARS, every_row: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, mix_source, block, release, deadline, slot, offset, in_mix.

    ``offset`` is the number of characters of the source before the document; (slot,
    offset, doc_id) is the order of the mix.  Rows equal in id, text and source of the weights follow
    one another; without ``every_row`` they have one row, that of the first.
    """
    spark = docs.sparkSession
    share = shares(weights or WEIGHTS, slots)
    # by id and text: neither rows without an id nor an id with many texts meet in one bucket
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("\n"), whole_text(text_col)).cast("binary"))
    rows = (docs.select(F.col(id_col).alias("doc_id"), text_hash(text_col).alias("text_hash"),
                        _mix_source(share, source_col).alias("mix_source"),
                        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("_o"),
                        F.length(whole_text(text_col)).cast("long").alias("_one"))
            .groupBy("doc_id", "text_hash", "mix_source", "_o", "_one").agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_size", F.col("_one") * F.col("_copies")))
    rows = cut(rows, "mix-rows")
    bits = max(0, math.ceil(math.log2(max(1, rows.count()) / ROWS_PER_BUCKET)))
    rows = rows.withColumn("_b", F.shiftright("_o", 60 - bits))
    # running sizes: over the buckets of a source, then within a bucket
    sums = rows.groupBy("mix_source", "_b").agg(F.sum("_size").alias("_sum"))
    earlier = Window.partitionBy("mix_source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(sums.select("mix_source", "_b", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
                             "_sum"), "mix-starts")
    within = Window.partitionBy("mix_source", "_b").orderBy("_o", F.col("doc_id").asc_nulls_first(), "text_hash") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn("_in", F.coalesce(F.sum("_size").over(within), F.lit(0)))
              .join(starts.drop("_sum"), ["mix_source", "_b"])
              .withColumn("offset", F.col("_start") + F.col("_in")))
    if every_row:
        # the copies one by one, in two steps: no task holds a list of all
        groups = F.expr(f"explode(sequence(0L, (_copies - 1) div {COPIES_AT_ONCE}))")
        copies = F.expr(f"explode(sequence(_group * {COPIES_AT_ONCE}, least((_group + 1) * {COPIES_AT_ONCE}, _copies) - 1))")
        placed = (placed.withColumn("_group", groups).withColumn("_copy", copies)
                  .withColumn("offset", F.col("offset") + F.col("_copy") * F.col("_one")))
    steps = period(share)
    table = spark.createDataFrame([(s, j, t, share[s]) for t, (s, j) in enumerate(steps)],
                                  "mix_source string, _j long, _t long, _share long")
    blocks = (placed.withColumn("block", F.expr(f"`offset` div {block_chars}"))
              .join(F.broadcast(table.groupBy("mix_source").agg(F.max("_share").alias("_a"))), "mix_source")
              .withColumn("_j", F.col("block") % F.col("_a")).withColumn("_cycle", F.expr("block div _a"))
              .join(F.broadcast(table.drop("_share")), ["mix_source", "_j"]))  # ``slots`` rows
    slot = F.col("_cycle") * slots + F.col("_t")
    # the first slot that some source cannot fill; at most one number per weight reaches the driver
    size = {r[0]: r[1] for r in starts.groupBy("mix_source").agg(F.sum("_sum")).collect()}
    place = {(s, j): t for t, (s, j) in enumerate(steps)}
    first_gap = min((n := -(-size.get(s, 0) // block_chars)) // a * slots + place[s, n % a]
                    for s, a in share.items())
    return blocks.select(
        "doc_id", "text_hash", "mix_source", "block", F.expr(f"block * {slots} div _a").alias("release"),
        F.expr(f"((block + 1) * {slots} + _a - 1) div _a").alias("deadline"), slot.alias("slot"), "offset",
        (slot < first_gap).alias("in_mix"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``docs`` in the order of the mix, with mix_source, slot, mix_offset and in_mix (replaced if there)."""
    docs, (id_col, text_col, source_col), unseal = seal(docs, id_col, text_col, source_col)
    plan = cut(schedule(docs, weights, id_col, text_col, source_col, every_row=False, **settings).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "mix_source", "slot",
        F.col("offset").alias("mix_offset"), "in_mix"), "mix-plan")
    own = _mix_source(shares(weights or WEIGHTS, settings.get("slots", SLOTS)), source_col)
    same = (F.col(id_col).eqNullSafe(F.col("_id")) & (text_hash(text_col) == F.col("_hash"))
            & (own == F.col("mix_source")))
    order = ["slot", "mix_offset", id_col]
    # a merge join at every size: the plan grows with the documents
    return unseal(docs.join(plan.hint("merge"), same).repartitionByRange(*order).sortWithinPartitions(*order),
                  "mix_source", "slot", "mix_offset", "in_mix")
