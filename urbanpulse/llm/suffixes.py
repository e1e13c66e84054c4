"""Suffix-array deduplication of repeated byte strings by distributed prefix doubling.

A byte is removed when it lies in a string of ``length`` bytes that also starts
earlier: in a smaller document (id, then text hash), or earlier in the same one.
Overlaps count; matches never cross documents; strings are judged on the input.

Prefix doubling ranks every suffix by its first h bytes, then by pairs of ranks at
offset h, until ranks are unique or 2h passes the threshold.  Here:

1. **First ranks, h = length / 2, on a sample that loses nothing.**  Of the suffixes
   that start in a window of ``length`` bytes, the one whose first h bytes hash
   lowest stands for the window (its anchor): equal windows have equal anchors at
   equal places, so a window can only repeat where its anchor's rank repeats.
   Spark groups the anchors by rank; unique ones drop out, usually nearly all.
2. **Reranking in context.**  An anchor left over is ranked again by everything
   its windows cover (up to 3h bytes).  Within one such class all windows are
   equal, so all but the first member are repeats as a whole: long repeats and
   exact copies are settled here without a row per byte.
3. **Closer context.**  Where classes share an anchor rank (a repeat starts or ends
   nearby), the windows of each class's first member are taken eight at a time.  Runs
   whose common bytes are unique drop out; of equal runs all but the first are repeats.
4. **Doubling.**  The windows of the first of each run that is still shared are ranked
   by the pair (rank at p, rank at p + h).  The first window of a pair stays, the
   others are repeats; 2h reaches the threshold, so this is the last round.

Ranks are names (64 bits for a half, 128 for what decides), given per content; the
order among equals is the position.  All steps are partial aggregations and joins
that Spark can split; a hot repeat never meets in one task.

Nulls and empty texts have no bytes.  Rows equal in id and text count as one
document.  Ties of an id are ordered by text hash.  An empty table gives an empty
result.  Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, discard, one_of_each, seal, utf8, whole_text

LENGTH = 100
RUN = 8
_CHUNK = 1 << 19  # window starts ranked at once
_PLACE = 20       # bits of a place in a chunk
_BASE = np.uint64(0x2D358DCCAA6C78A5)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """Names of the strings of ``half`` bytes that start at each place of a chunk."""

    def __init__(self, half: int, most: int):
        powers = np.full(most, _BASE, dtype=np.uint64)
        powers[0] = 1
        inverse = np.full(most, np.uint64(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64)
        inverse[0] = 1
        self.half = half
        self.powers = np.multiply.accumulate(powers)
        self.inverse = np.multiply.accumulate(inverse)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=total[1:])
        name = (total[self.half:] - total[:-self.half]) * self.inverse[:n - self.half + 1]
        name ^= name >> np.uint64(32)
        name *= _MIX
        name ^= name >> np.uint64(29)
        return name


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(ranks: Ranks, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """Anchors of all windows of a chunk: (document, place, first window, last window, name)."""
    names = ranks(data)
    low = np.uint64((1 << _PLACE) - 1)
    keys = (names & ~low) | np.arange(len(names), dtype=np.uint64)
    least = (_sliding_min(keys, length - ranks.half + 1) & low).astype(np.int64)
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    has = ends - starts >= length
    edge[starts[has]] = 1
    edge[ends[has] - length + 1] -= 1  # a start there again is +1 - 1
    window = np.flatnonzero(np.cumsum(edge[:len(least)], dtype=np.int8))
    anchor = least[window]
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]]) if len(anchor) else np.zeros(0, np.int64)
    last = np.r_[new[1:], len(anchor)] - 1 if len(new) else new
    place = anchor[new]
    owner = np.searchsorted(starts, place, "right") - 1
    return owner, place, window[new], window[last], names[place]


def _chunks(offsets: np.ndarray, length: int):
    """(from byte, to byte, first document, last document + 1, bytes before) of pieces with bounded size."""
    n, at = len(offsets) - 1, 0
    while at < n:
        size = offsets[at + 1] - offsets[at]
        if size > _CHUNK:
            for start in range(0, max(1, int(size) - length + 1), _CHUNK):
                yield (int(offsets[at]) + start, int(min(offsets[at + 1], offsets[at] + start + _CHUNK + length - 1)),
                       at, at + 1, start)
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK, "right")) - 1)
        yield int(offsets[at]), int(offsets[to]), at, to, 0
        at = to


def _pack(place, first, last):
    """One integer that sorts by place: place, distance of the first and of the last window."""
    return place << 32 | (place - first) << 16 | (place - last)


def _unpack(at):
    place = at >> 32
    return place, place - (at >> 16 & 0xFFFF), place - (at & 0xFFFF)


def _emit_anchors(length: int, where: bool):
    """mapInArrow body: (doc_id, th, text) -> ranks of anchors, with their places if asked."""
    half = (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(half, _CHUNK + length)
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b, d0, d1, before in _chunks(offsets, length):
                if b - a < length:
                    continue
                starts = np.maximum(offsets[d0:d1], a) - a
                ends = np.minimum(offsets[d0 + 1:d1 + 1], b) - a
                owner, place, first, last, name = anchors(ranks, data[a:b], starts, ends, length)
                if not len(place):
                    continue
                name = pa.array(name.view(np.int64))
                if not where:
                    yield pa.RecordBatch.from_arrays([name], names=["rank"])
                    continue
                local = starts[owner] - before
                at = _pack(place - local, first - local, last - local)
                owner = pa.array(owner + d0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(at), name],
                    names=["doc_id", "th", "at", "rank"])

    return run


def _emit_contexts(length: int):
    """mapInArrow body: (doc_id, th, text, places) -> each anchor's rank and its class in context."""
    half = (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            view = memoryview(data)
            places = batch.column(3)
            counts = np.diff(places.offsets.to_numpy()).astype(np.int64)
            at = places.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), counts)
            place, first, last = _unpack(at)
            shift = offsets[owner]
            seed = (at & 0xFFFFFFFF).tolist()
            context = b"".join(
                xxhash.xxh3_128_digest(view[i:j], s)
                for i, j, s in zip((first + shift).tolist(), (last + shift + length).tolist(), seed, strict=True))
            rank = np.fromiter((xxhash.xxh3_64_intdigest(view[i:i + half]) for i in (place + shift).tolist()),
                               dtype=np.uint64, count=len(at))
            pair = np.frombuffer(context, dtype=np.int64).reshape(-1, 2)
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(rank.view(np.int64)),
                 batch.column(0).take(owner), batch.column(1).take(owner), pa.array(at)],
                names=["c1", "c2", "rank", "doc_id", "th", "at"])

    return run


def _emit_runs(length: int):
    """mapInArrow body: (doc_id, th, text, places) -> the anchors' windows in runs of up to ``RUN``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            view = memoryview(data)
            places = batch.column(3)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
            place, first, last = _unpack(places.flatten().to_numpy())
            # run q holds the windows that start 8q to 8q + 7 bytes before the anchor
            low, high = (place - last) // RUN, (place - first) // RUN
            pick = np.repeat(np.arange(len(place)), high - low + 1)
            q = low[pick] + np.arange(len(pick)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
            owner, place, first, last = owner[pick], place[pick], first[pick], last[pick]
            start = np.maximum(first, place - RUN * q - RUN + 1)
            end = np.minimum(last, place - RUN * q)
            shift = offsets[owner]
            full = b"".join(
                xxhash.xxh3_128_digest(view[i:j], s) for i, j, s in
                zip((start + shift).tolist(), (end + shift + length).tolist(),
                    ((place - start) << 16 | (place - end)).tolist(), strict=True))
            common = np.fromiter(
                (xxhash.xxh3_64_intdigest(view[i:i + length - RUN + 1], s) for i, s in
                 zip((place - RUN * q + shift).tolist(), q.tolist(), strict=True)), dtype=np.uint64, count=len(q))
            pair = np.frombuffer(full, dtype=np.int64).reshape(-1, 2)
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(common.view(np.int64)),
                 batch.column(0).take(owner), batch.column(1).take(owner), pa.array(start << 32 | (end - start))],
                names=["c1", "c2", "rank", "doc_id", "th", "at"])

    return run


def _emit_windows(length: int):
    """mapInArrow body: (doc_id, th, text, runs) -> rank pairs of the runs' windows."""
    half = (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(half, _CHUNK + length)
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            places = batch.column(3)
            bounds = places.offsets.to_numpy().astype(np.int64)
            at = places.flatten().to_numpy()
            first, last = at >> 32, (at >> 32) + (at & 0xFFFFFFFF)
            bounds = bounds - bounds[0]
            for k in range(batch.num_rows):
                size = int(offsets[k + 1] - offsets[k])
                edge = np.zeros(size + 2, dtype=np.int64)
                of = slice(bounds[k], bounds[k + 1])
                np.add.at(edge, first[of], 1)
                np.add.at(edge, last[of] + 1, -1)
                chosen = np.flatnonzero(np.cumsum(edge) > 0)
                for start in range(0, size, _CHUNK):
                    p = chosen[np.searchsorted(chosen, start):np.searchsorted(chosen, start + _CHUNK)]
                    if not len(p):
                        continue
                    name = ranks(data[offsets[k] + start:min(offsets[k + 1], offsets[k] + start + _CHUNK + length - 1)])
                    one, two = name[p - start], name[p - start + length - half]
                    owner = pa.array(np.full(len(p), k))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), batch.column(0).take(owner),
                         batch.column(1).take(owner), pa.array(p)], names=["c1", "c2", "doc_id", "th", "at"])

    return run


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: text and its repeated intervals (packed) -> spans and the bytes that stay."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        text = batch.schema.get_field_index("_text")
        data, offsets = utf8(batch.column(text))
        view = memoryview(data)
        spans, kept = [], []
        for k, found in enumerate(batch.column(batch.schema.get_field_index("_cover"))):
            a, b = int(offsets[k]), int(offsets[k + 1])
            if not found.is_valid or not len(found.values):
                spans.append([])
                kept.append(view[a:b].tobytes())
                continue
            x = found.values.to_numpy()
            start, size = x >> 24, x & 0xFFFFFF  # a size is at most twice the length
            order = np.argsort(start, kind="stable")
            start, reach = start[order], np.maximum.accumulate((start + size)[order])
            new = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
            start, reach = start[new], reach[np.r_[new[1:], len(reach)] - 1]
            spans.append([{"start": int(i), "end": int(j)} for i, j in zip(start, reach, strict=True)])
            edges = np.r_[0, np.stack([start, reach], axis=1).ravel(), b - a].tolist()
            kept.append(b"".join(view[a + i:a + j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
        keep = [i for i, f in enumerate(batch.schema.names) if f not in ("_text", "_cover")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in keep), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
            names=[*(batch.schema.names[i] for i in keep), "removed", "kept"])


def repeated_intervals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """The keyed documents, and per document (doc_id, th) the intervals whose bytes are repeats, packed."""
    if not 2 * RUN <= length <= 1 << 15:
        raise ValueError(f"length must be {2 * RUN} to 32768")
    keyed, rows = one_of_each(docs, id_col, text_col)
    keyed = keyed.withColumn("_text", whole_text(text_col))
    rows = rows.where(F.octet_length("text") >= length)
    kind = rows.schema["doc_id"].dataType.simpleString()
    key = f"doc_id {kind}, th long"

    # 1. first ranks; unique ones drop out
    often = cut(rows.mapInArrow(_emit_anchors(length, False), "rank long").groupBy("rank").count()
                .where("count > 1").select("rank"), "suffix-ranks")
    left = rows.mapInArrow(_emit_anchors(length, True), f"{key}, at long, rank long") \
        .join(often, "rank", "left_semi").groupBy("doc_id", "th").agg(F.collect_list("at").alias("places"))

    def with_text(places: DataFrame) -> DataFrame:
        # merge joins at every size: the places grow with the documents
        return (rows.alias("d").join(places.hint("merge").alias("p"), F.expr("d.doc_id <=> p.doc_id and d.th = p.th"))
                .select("d.doc_id", "d.th", "d.text", "p.places"))

    me = F.struct("doc_id", "th", "at")

    def classes(ranked: DataFrame, *more) -> DataFrame:
        """First member and size of each class."""
        return cut(ranked.groupBy("c1", "c2").agg(F.min(me).alias("first"), F.count(F.lit(1)).alias("n"), *more),
                   "suffix-classes")

    def covered(ranked: DataFrame, first: DataFrame, start, size) -> DataFrame:
        """Per document: intervals (packed) of all members but the first of their class."""
        late = (ranked.join(first.where("n > 1").select("c1", "c2", "first"), ["c1", "c2"])
                .where(me != F.col("first")))
        return cut(late.groupBy("doc_id", "th").agg(F.collect_list(
            F.shiftleft(start, 24).bitwiseOR(size.cast("long"))).alias("cover")), "suffix-cover")

    def shared(first: DataFrame) -> DataFrame:
        """Per document: first members of the classes that share their rank with another class."""
        often = cut(first.groupBy("rank").count().where("count > 1").select("rank"), "suffix-ranks")
        places = cut(first.join(often, "rank", "left_semi").select("first.*")
                     .groupBy("doc_id", "th").agg(F.collect_list("at").alias("places")), "suffix-places")
        discard(often)
        return places

    # 2. ranks in context; all but the first of a class are repeats as a whole
    low = F.lit(0xFFFF)
    ranked = cut(with_text(left).mapInArrow(_emit_contexts(length), f"c1 long, c2 long, rank long, {key}, at long"),
                 "suffix-contexts")
    discard(often)
    first = classes(ranked, F.min("rank").alias("rank"))
    to_first = F.shiftright("at", 16).bitwiseAND(low)
    cover = covered(ranked, first, F.shiftright("at", 32) - to_first,
                    to_first - F.col("at").bitwiseAND(low) + length)

    # 3. the same for runs of windows, where classes share a rank
    places = shared(first)
    discard(ranked, first)
    ranked = cut(with_text(places).mapInArrow(
        _emit_runs(length), f"c1 long, c2 long, rank long, {key}, at long"), "suffix-runs")
    discard(places)
    first = classes(ranked, F.min("rank").alias("rank"))
    cover = cover.unionByName(covered(ranked, first, F.shiftright("at", 32),
                                      F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)) + length))

    # 4. rank pairs of single windows
    places = shared(first)
    discard(ranked, first)
    ranked = cut(with_text(places).mapInArrow(_emit_windows(length), f"c1 long, c2 long, {key}, at long"),
                 "suffix-pairs")
    first = classes(ranked)
    cover = cover.unionByName(covered(ranked, first, F.col("at"), F.lit(length)))
    discard(places, ranked, first)
    return keyed, cover.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("cover")).alias("_cover"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH) -> DataFrame:
    """``docs`` with ``removed`` (byte spans) and ``kept`` (the other bytes); such columns are replaced."""
    docs, (id_col, text_col), unseal = seal(docs, id_col, text_col)
    keyed, cover = repeated_intervals(docs, id_col, text_col, length)
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("th"))
    rows = keyed.join(cover.withColumnRenamed("doc_id", "_id").hint("merge"), same, "left").drop("_id", "th", "_th")
    kept = [f for f in rows.schema.fields if f.name not in ("_text", "_cover")]
    schema = T.StructType([*kept, *T._parse_datatype_string(
        "removed array<struct<start:long,end:long>>, kept binary").fields])
    return unseal(rows.mapInArrow(_remove, schema), "removed", "kept")
