"""Line dedup: a suffix array over line numbers by distributed prefix doubling.

Every line is named by its content (surrounding white space aside), so a document
is a sequence of names.  A *window* is the shortest run of lines from a given line
on that has ``min_words`` words (forward) or the shortest that ends at a given line
(backward); equal windows have equal lines.  A line is deleted when it lies in a
window that also starts earlier: in a smaller document (id, then text hash), or
further up in the same one.

A repeated run of ``min_words`` words or more is the union of its forward and
backward windows: ``whole_runs`` (the default) judges both and deletes the whole maximal
repeated runs (the longest-common-prefix intervals); the first copy stays.  Forward windows
alone miss the lines at the end of a run that have fewer words than ``min_words`` from
their start to the end of the run.

Doubling: the class of a suffix by its first 2^k lines is named by the first
position of the class.  Spark groups the pairs (name at i, name at i + 2^k), gives
each repeated pair a name, and drops suffixes whose pair is unique: nothing that
starts there can repeat.  A window of n lines, 2^k <= n < 2^(k+1), is decided in
round k by the two overlapping names that cover it.  Rounds end when no longer
window is left.  A common line's rows never meet in one task: names are partial
aggregates, and joins with them are joins with stored tables that Spark can split.

Nulls and empty texts: one empty line, never deleted.  Rows equal in id and text
count as one document, whose lines are ranked once, and all get its result.  Ties of an id are ordered by text hash.  An empty table
gives an empty result.  Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, one_of_each, seal, texts

MIN_WORDS = 50


def _name_lines(min_words: int, whole_runs: bool):
    """mapInArrow body: (doc_id, th, text) -> a row per line: number, 128-bit name, lines of the windows from it on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in enumerate(texts(batch.column(2))):
                parts = text.split(b"\n")
                n = len(parts)
                total = np.cumsum(np.fromiter((len(x.split()) for x in parts), dtype=np.int64, count=n))
                before = np.r_[0, total[:-1]]
                last = np.searchsorted(total, before + min_words)
                if last[0] == n:
                    continue  # fewer words than a window has: no line of it can be deleted
                start = np.flatnonzero(last < n)
                window = start << 32 | (last[start] - start + 1)
                if whole_runs:
                    # the last line from which ``min_words`` words end at each line
                    first = np.searchsorted(before, total - min_words, side="right") - 1
                    end = np.flatnonzero(first >= 0)
                    window = np.union1d(window, first[end] << 32 | (end - first[end] + 1))
                edge = np.searchsorted(window >> 32, np.arange(n + 1)).astype(np.int32)
                sizes = pa.array((window & 0xFFFFFFFF).astype(np.int32))
                name = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.strip()) for x in parts),
                                     dtype=np.int64).reshape(n, 2)
                owner = pa.array(np.full(n, k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(np.arange(n, dtype=np.int32)),
                     pa.ListArray.from_arrays(edge, sizes), pa.array(name[:, 0]), pa.array(name[:, 1])],
                    names=["doc_id", "th", "line", "windows", "a", "b"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: small batches of lines -> larger ones."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 20_000:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def repeated_windows(rows: DataFrame, min_words: int = MIN_WORDS, whole_runs: bool = False) -> DataFrame:
    """(doc_id, th, line, window): windows of ``rows`` (doc_id, th, text) that also start earlier."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    name_lines = _name_lines(min_words, whole_runs)

    def first_names(batches):
        return _merge(name_lines(batches))

    lines = cut(rows.mapInArrow(first_names, f"doc_id {kind}, th long, line int, windows array<int>, a long, b long"),
                "lines-all")
    me = F.struct("doc_id", "th", "line")

    def leaders(table: DataFrame, keys: list[str]) -> DataFrame:
        """The first position of every repeated key."""
        return cut(table.groupBy(*keys).agg(F.min(me).alias("name"), F.count(F.lit(1)).alias("times"))
                   .where("times > 1").drop("times"), "lines-names")

    def renamed(table: DataFrame, keys: list[str]) -> DataFrame:
        kept = [c for c in ("window", "windows") if c in table.columns]
        return table.join(leaders(table, keys), keys).select("doc_id", "th", "line", *kept, "name")

    def exact(table: DataFrame, size: int) -> DataFrame:
        return (table.where(F.array_contains("windows", size)).where(me != F.col("name"))
                .select("doc_id", "th", "line", F.lit(size).alias("window")))

    now = cut(renamed(lines, ["a", "b"]), "lines-round")
    found = exact(now, 1)
    step = 1
    while (now.agg(F.max(F.array_max("windows"))).first()[0] or 0) > step:
        # pairs of names at offset ``step``: a frame of just that line of the document
        ahead = Window.partitionBy("doc_id", "th").orderBy("line").rangeBetween(step, step)
        pairs = cut(now.withColumnRenamed("name", "one").withColumn("two", F.first("one").over(ahead))
                    .where("two is not null"), "lines-pairs")
        now = cut(renamed(pairs, ["one", "two"]), "lines-round")
        step *= 2
        found = found.unionByName(exact(now, step))
        # windows of more lines, but not twice as many: two overlapping names
        between = now.select("doc_id", "th", "line", F.col("name").alias("one"), F.explode(F.expr(
            f"filter(windows, x -> x > {step} and x < {2 * step})")).alias("window")).withColumn(
            "at", F.col("line") + F.col("window") - step)
        tail = now.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("line").alias("_l"),
                          F.col("name").alias("two"))
        covered = cut(between.join(tail, F.expr("doc_id <=> _d and th = _t and at = _l"))
                      .select("doc_id", "th", "line", "window", "one", "two"), "lines-covered")
        found = found.unionByName(renamed(covered, ["window", "one", "two"]).where(me != F.col("name")).drop("name"))
    return found.select("doc_id", "th", "line", "window")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS, whole_runs: bool = True) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from the text, ``n_lines`` and ``removed``.

    ``removed`` lists the deleted runs (first line, line after the last).  Columns with
    these names are replaced.  ``whole_runs``: to the last line of every repeated run.
    """
    docs, (id_col, text_col), unseal = seal(docs, id_col, text_col)
    keyed, rows = one_of_each(docs, id_col, text_col)
    deleted = repeated_windows(rows, min_words, whole_runs).groupBy("doc_id", "th").agg(F.collect_set(
        F.shiftleft(F.col("line").cast("long"), 32).bitwiseOR(F.col("window").cast("long"))).alias("_runs"))
    deleted = cut(deleted, "lines-deleted").withColumnRenamed("doc_id", "_id")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("th"))
    # a merge join at every size: what is deleted grows with the documents
    joined = keyed.join(deleted.hint("merge"), same, "left").drop("_id", "th", "_th")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            column = batch.column(at)
            changed, counts, spans = [], [], []
            for text, runs, null in zip(texts(column), batch.column(batch.num_columns - 1),
                                        column.is_null().to_pylist(), strict=True):
                counts.append(text.count(b"\n") + 1)
                if not runs.is_valid:
                    spans.append([])
                    changed.append(None if null else text)
                    continue
                x = runs.values.to_numpy()
                edge = np.zeros(counts[-1] + 1, dtype=np.int64)
                np.add.at(edge, x >> 32, 1)
                np.add.at(edge, (x >> 32) + (x & 0xFFFFFFFF), -1)
                gone = np.cumsum(edge)[:-1] > 0
                changed.append(b"\n".join(p for p, g in zip(text.split(b"\n"), gone.tolist(), strict=True) if not g))
                turn = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                spans.append([{"start": int(a), "end": int(b)} for a, b in turn.reshape(-1, 2)])
            columns = [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(spans, spans_type)]
            columns[at] = pa.array(changed, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "n_lines", "removed"])

    fields = [T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in docs.schema.fields]
    schema = T.StructType([*fields, *T._parse_datatype_string(
        "n_lines long, removed array<struct<start:long,end:long>>").fields])
    return unseal(joined.mapInArrow(run, schema), "n_lines", "removed")


def n_removed(removed: str = "removed"):
    return F.aggregate(removed, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
