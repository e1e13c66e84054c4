"""SimHash near-dedup over a Gray-order hierarchical index.

A fingerprint has 64 bits; bit i is set when it is set in over half of the
XXH64 hashes of the document's word shingles.  Two documents are linked when
their fingerprints differ in at most ``max_bits`` bits; linked documents form
components.

Finding the links
-----------------
1. Only distinct fingerprints are searched; documents meet them again at the end.
2. **Routing.**  The 64 bits are cut into ``max_bits + 1`` blocks.  Two
   fingerprints within ``max_bits`` agree in one block at least, so a group per
   (block, value) holds every link.  A group of over ``max_group`` members is cut
   again: the bits that are still free are divided in the same way, and the
   same argument holds for them.  After six cuts at most 12 bits are free, so no
   group can exceed 4,096 members whatever the data.  Nothing is dropped.
3. **Index.**  Within a group, fingerprints are sorted by Gray rank, so that
   neighbours share most bits.  Every ``FANOUT`` neighbours get an upper node
   that holds the bits they share (a mask and a pattern), up to one root.  A
   query carries its accumulated differences from node to node, counts only the
   bits that a node adds to its parent, and leaves a whole subtree as soon as
   the sum exceeds ``max_bits``.
4. Each group hands on a spanning forest of its links (fewer edges than members),
   never all pairs.  ``components`` joins the forests by alternating large-star
   and small-star steps on distributed tables.

Nulls, empty texts: fingerprint zero, linked like any other.  Repeated rows and
ties have one fingerprint and one component.  An empty table gives an empty
result.  Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import cut, seal, text_hash, texts, whole_text

BITS = 64
FANOUT = 8
MAX_CUTS = 6
_CHUNK = 1 << 16
_FRONTIER = 1 << 21


# --- fingerprints ---------------------------------------------------------

def simhash(data: bytes, shingle: int, seed: int) -> int:
    """Fingerprint of one text, as an unsigned integer."""
    words = data.lower().split()  # bytes: lower() changes A-Z only, split() on x20, x09-x0D
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)  # its only hash decides each bit
    n = len(words) - shingle + 1
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(seed))
    counts = np.zeros(BITS, dtype=np.int64)
    left = n
    while left:  # in pieces: a very long text needs no more memory than its words
        piece = np.fromiter(hashes, dtype="<u8", count=min(left, _CHUNK))
        left -= len(piece)
        bits = np.unpackbits(piece.view(np.uint8).reshape(len(piece), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text_col: str = "text", shingle: int = 3, seed: int = 42) -> Column:
    """Column expression: SimHash of the text as a signed 64-bit value."""

    @arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        values = np.fromiter((simhash(t, shingle, seed) for t in texts(column)),
                             dtype=np.uint64, count=len(column))
        return pa.array(values.view(np.int64))

    return run(whole_text(text_col))


# --- Gray-order hierarchical index ------------------------------------------

def gray_rank(bits: Column) -> Column:
    """Rank of a 64-bit word in Gray code order (exclusive-or of all higher bits)."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; label[x] is the smallest index of x's set."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _levels(group: np.ndarray, bits: np.ndarray) -> list[dict]:
    """Index levels of all groups at once, leaves first; sorted by (group, Gray rank)."""
    level = {"group": group, "bits": bits, "mask": np.full(len(bits), ~np.uint64(0))}
    out = [level]
    while True:
        group = level["group"]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        if len(starts) == len(group):
            return out
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))
        first = np.flatnonzero(place % FANOUT == 0)
        every = np.bitwise_and.reduceat(level["bits"], first)
        some = np.bitwise_or.reduceat(level["bits"], first)
        mask = np.bitwise_and.reduceat(level["mask"], first) & ~(every ^ some)
        level = {"group": group[first], "bits": every & mask, "mask": mask, "first": first,
                 "children": np.diff(np.r_[first, len(group)])}
        out.append(level)


def link_groups(group: np.ndarray, bits: np.ndarray, max_bits: int) -> np.ndarray:
    """Smallest index linked to each entry within its group (itself if none is)."""
    n = len(bits)
    label = np.arange(n)
    if n < 2:
        return label
    levels = _levels(group, bits)
    top = len(levels) - 1
    if top == 0:
        return label
    root = np.searchsorted(levels[top]["group"], group)
    todo = [(top, np.arange(n), root, np.zeros(n, dtype=np.uint8))]
    while todo:
        at, query, node, acc = todo.pop()
        width = levels[at]["children"][node]
        if width.sum() > _FRONTIER and len(query) > 1:
            half = len(query) // 2
            todo += [(at, query[:half], node[:half], acc[:half]),
                     (at, query[half:], node[half:], acc[half:])]
            continue
        parent = np.repeat(np.arange(len(query)), width)
        step = np.arange(len(parent)) - np.repeat(np.cumsum(width) - width, width)
        child = levels[at]["first"][node][parent] + step
        below = levels[at - 1]
        added = below["mask"][child] & ~levels[at]["mask"][node][parent]
        total = acc[parent] + np.bitwise_count((bits[query][parent] ^ below["bits"][child]) & added)
        near = total <= max_bits
        query, child, total = query[parent[near]], child[near], total[near]
        if at == 1:
            later = child > query
            _hook(label, query[later], child[later])
        elif len(query):
            todo.append((at - 1, query, child, total.astype(np.uint8)))
    return label


def _search(max_bits: int):
    """mapInArrow body: partitions sorted by group and Gray rank -> forest edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

        def edges(path, fixed, fp):
            if not len(fp):
                return None
            change = (path[1:] != path[:-1]) | (fixed[1:] != fixed[:-1])
            group = np.cumsum(np.r_[0, change])
            label = link_groups(group, fp.view(np.uint64), max_bits)
            linked = np.flatnonzero(label != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[linked]), pa.array(fp[label[linked]])], names=["a", "b"])

        for batch in batches:
            now = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)])
                   for i, h in enumerate(held)]
            if not len(now[0]):
                continue
            # the last group may go on in the next batch
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            end = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            held = [x[end:] for x in now]
            out = edges(*(x[:end] for x in now))
            if out is not None and out.num_rows:
                yield out
        out = edges(*held)
        if out is not None and out.num_rows:
            yield out

    return run


def _cut_bits(rows: DataFrame, free: int, blocks: int) -> DataFrame:
    """One row per block: the block's value joins ``fixed``, the other bits stay in ``rest``."""
    width = free // blocks
    low = (1 << width) - 1

    def block(j: int) -> Column:
        rest = F.col("rest")
        below = rest.bitwiseAND(F.lit((1 << (j * width)) - 1))
        above = F.shiftleft(F.shiftrightunsigned(rest, (j + 1) * width), j * width) \
            if (j + 1) * width < BITS else F.lit(0).cast("long")
        value = F.shiftrightunsigned(rest, j * width).bitwiseAND(F.lit(low))
        return F.struct((F.col("path") * blocks + j).alias("path"),
                        F.shiftleft("fixed", width).bitwiseOR(value).alias("fixed"),
                        above.bitwiseOR(below).alias("rest"))

    return (rows.select("fp", F.explode(F.array(*(block(j) for j in range(blocks)))).alias("c"))
            .select("fp", "c.path", "c.fixed", "c.rest"))


def link_forest(fingerprints: DataFrame, max_bits: int = 3, max_group: int = 1024) -> DataFrame:
    """Edges (a, b) that connect the distinct values of ``fp`` as their links do."""
    blocks, free = max_bits + 1, BITS
    rows = fingerprints.select("fp", F.lit(1).cast("long").alias("path"),
                               F.lit(0).cast("long").alias("fixed"), F.col("fp").alias("rest"))
    forest = None
    for turn in range(MAX_CUTS):
        rows = _cut_bits(rows, free, blocks)
        free -= free // blocks
        more = None
        if turn + 1 < MAX_CUTS:
            large = cut(rows.groupBy("path", "fixed").count().where(F.col("count") > max_group)
                        .select("path", "fixed"), "simhash-large")
            if not large.isEmpty():
                more = cut(rows.join(large, ["path", "fixed"], "left_semi"), "simhash-again")
                rows = rows.join(large, ["path", "fixed"], "left_anti")
        ready = (rows.repartition("path", "fixed")
                 .select("path", "fixed", "fp", gray_rank(F.col("fp")).alias("rank"))
                 .sortWithinPartitions("path", "fixed", "rank").drop("rank"))
        found = ready.mapInArrow(_search(max_bits), "a long, b long")
        forest = found if forest is None else forest.unionByName(found)
        if more is None:
            return forest
        rows = more
    return forest


# --- components -------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node of an edge.

    Alternating large-star and small-star steps on tables in the shared folder.
    A step only takes minima per node (combined before the shuffle) and joins
    them back (Spark splits a hot node's side), so no neighbourhood is ever
    gathered in one place.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def mark(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()

    now = cut(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
              .where("hi <> lo").distinct(), "components")
    before = None
    while (state := mark(now)) != before:
        before = state
        if not state[0]:
            break
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        large = cut(large, "components")
        down = large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        least = smallest(down)
        small = (down.join(least, "u").where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct())
        now = cut(small, "components")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


# --- operators ----------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, seed: int = 42, max_bits: int = 3,
                    max_group: int = 1024) -> DataFrame:
    """One row per document: its id, ``text_hash``, ``fp`` and ``class_fp``.

    ``class_fp`` is one fingerprint of the document's component.  The rows lie in
    the shared folder.
    """
    marked = cut(docs.select(F.col(id_col).alias("doc_id"), text_hash(text_col).alias("text_hash"),
                             fingerprint(text_col, shingle, seed).alias("fp")), "simhash-docs")
    distinct = marked.select("fp").distinct()
    forest = link_forest(distinct, max_bits, max_group)
    # written tables on the small side: Spark can then split a hot fingerprint's rows
    roots = cut(components(forest).select(F.col("node").alias("fp"), F.col("root").alias("class_fp")),
                "simhash-roots")
    return (marked.join(roots, "fp", "left")
            .select("doc_id", "text_hash", "fp", F.coalesce("class_fp", "fp").alias("class_fp")))


def classes(docs: DataFrame, **settings) -> DataFrame:
    """``near_duplicates`` with ``component_id``, the smallest id of the class."""
    rows = cut(near_duplicates(docs, **settings), "simhash-classes")
    least = cut(rows.groupBy("class_fp").agg(F.min("doc_id").alias("component_id")), "simhash-least")
    return rows.join(least, "class_fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with one document per component: the smallest (id, text hash).

    A null id sorts first.  Of rows equal in id and text, one stays.
    """
    docs, (id_col, text_col), unseal = seal(docs, id_col, text_col)
    rows = cut(near_duplicates(docs, id_col, text_col, **settings), "simhash-classes")
    first = (rows.groupBy("class_fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
             .select("k.doc_id", "k.text_hash"))
    times = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    keep = first.alias("f").join(times.alias("t"), F.expr(
        "f.doc_id <=> t.doc_id and f.text_hash = t.text_hash")).select(
        F.col("f.doc_id").alias("_id"), F.col("f.text_hash").alias("_hash"), F.col("t.times").alias("_times"))
    keep = cut(keep, "simhash-keep")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (text_hash(text_col) == F.col("_hash"))
    # a merge join at every size: what stays grows with the documents
    single = docs.join(keep.where("_times = 1").hint("merge"), same, "left_semi")
    repeated = keep.where("_times > 1")
    if repeated.isEmpty():
        return unseal(single)
    return unseal(single.unionByName(docs.join(repeated, same).dropDuplicates(["_id", "_hash"])
                                     .select(*docs.columns)))
