"""Document fingerprints: a quartile bucket digest with a bounded difference score.

Digest
------
A window of five bytes slides over the UTF-8 text (four zero bytes stand before
it).  Six byte triplets of each window, each led by its newest byte, are hashed
into ``BUCKETS`` buckets.  Each bucket count is encoded by its quartile among all buckets (two
bits).  The hex digest is: length code (logarithmic, one byte), the first and
second quartile as sixteenths of the third (one byte), then the bucket codes.

Score
-----
``difference`` adds the distances of the bucket codes (opposite quartiles count
``FAR``), of the length codes and of the quartile ratios; ``likeness`` maps it to
0..1: 1 for equal digests, 0 from ``LIMIT`` on.

``successors`` hands every document the next one in an order without a global
window: range partitions are read as streams, each keeps one row back, and only
the first and last row of each partition meet again in a small join.

Nulls and empty texts: the digest of no bytes.  Equal texts have equal digests.
Repeated rows and ties are ordered by text hash; a lone document is its own
successor.  An empty table gives an empty result.  Extra columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import cut, text_hash, texts, whole_text

BUCKETS = 128
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4), (1, 4), (3, 4))
FAR = 6
LIMIT = 400
LENGTH_BASE = 1.1
_CHUNK = 1 << 18
_MIX = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


def _counts(parts: list[bytes]) -> np.ndarray:
    """Bucket counts of some texts: one row each."""
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    pad = b"\0" * 4
    data = np.frombuffer(pad.join([b"", *parts]), dtype=np.uint8).astype(np.uint32)
    out = np.zeros(len(parts) * BUCKETS, dtype=np.int64)
    if not sizes.sum():
        return out.reshape(-1, BUCKETS)
    owner = np.repeat(np.arange(len(parts)) * BUCKETS, sizes)
    end = np.arange(len(owner)) + np.repeat(4 * np.arange(1, len(parts) + 1), sizes)
    newest = data[end]
    back = [newest, *(data[end - k] for k in range(1, 5))]
    for salt, (i, j) in enumerate(TRIPLETS, 1):
        key = newest | back[i] << np.uint32(8) | back[j] << np.uint32(16) | np.uint32(salt << 24)
        out += np.bincount(owner + (key * _MIX >> _SHIFT), minlength=len(out))
    return out.reshape(-1, BUCKETS)


def _bucket_counts(parts: list[bytes]) -> np.ndarray:
    """As ``_counts``, in pieces of bounded size."""
    out = np.zeros((len(parts), BUCKETS), dtype=np.int64)
    at = 0
    while at < len(parts):
        if len(parts[at]) > _CHUNK:  # a long text, by pieces that overlap by four bytes
            text = parts[at]
            out[at] = _counts([text[:_CHUNK]])[0]
            for start in range(_CHUNK, len(text), _CHUNK):
                piece = text[start - 4:start + _CHUNK]
                # windows that end in the overlap (and their padding) are not new
                out[at] += _counts([piece])[0] - _counts([piece[:4]])[0]
            at += 1
            continue
        to, size = at, 0
        while to < len(parts) and (size := size + len(parts[to])) <= _CHUNK:
            to += 1
        out[at:to] = _counts(parts[at:to])
        at = to
    return out


def codes(parts: list[bytes]) -> np.ndarray:
    """Digest of each text as a row of small integers: length, two ratios, bucket quartiles."""
    counts = _bucket_counts(parts)
    cuts = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, BUCKETS * 3 // 4 - 1]
    quartile = np.partition(counts, cuts, axis=1)[:, cuts] if len(parts) else np.zeros((0, 3), np.int64)
    body = (counts[:, :, None] > quartile[:, None, :]).sum(axis=2)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    length = np.minimum(255, np.rint(np.log1p(sizes) / np.log(LENGTH_BASE)).astype(np.int64))
    third = np.maximum(1, quartile[:, 2])
    ratios = np.minimum(15, quartile[:, :2] * 16 // third[:, None])
    return np.concatenate([length[:, None], ratios, body], axis=1).astype(np.int16)


def to_hex(rows: np.ndarray) -> list[str]:
    body = rows[:, 3:].reshape(len(rows), -1, 4) << np.array([6, 4, 2, 0], dtype=np.int16)
    head = np.stack([rows[:, 0], rows[:, 1] << 4 | rows[:, 2]], axis=1)
    packed = np.concatenate([head, body.sum(axis=2)], axis=1).astype(np.uint8)
    return [r.tobytes().hex() for r in packed]


def from_hex(digests: list[str]) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex("".join(digests)), dtype=np.uint8).reshape(len(digests), -1)
    packed = packed.astype(np.int16)
    body = packed[:, 2:, None] >> np.array([6, 4, 2, 0], dtype=np.int16) & 3
    return np.concatenate([packed[:, :1], packed[:, 1:2] >> 4, packed[:, 1:2] & 15,
                           body.reshape(len(packed), -1)], axis=1)


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Difference of digests, row by row."""
    gap = np.abs(a - b).astype(np.int64)
    body = gap[:, 3:]
    return np.where(body == 3, FAR, body).sum(axis=1) + 4 * gap[:, 0] + 4 * gap[:, 1:3].sum(axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1.0 - np.minimum(difference(a, b), LIMIT) / LIMIT


def fingerprint(text_col: str = "text") -> Column:
    """Column expression: the hex digest of the text."""

    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(to_hex(codes(list(texts(column)))), type=pa.string())

    return run(whole_text(text_col))


def compare(a: Column, b: Column) -> Column:
    """Column expression: likeness of two hex digests, 0 to 1."""

    @arrow_udf("double")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(likeness(from_hex(x.to_pylist()), from_hex(y.to_pylist())))

    return run(a, b)


def replace_end(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


RESULT = ("doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
_CLOSED, _OPEN, _HEAD = 0, 1, 2


def _rows(ids: list, own: list[str], following: list[str], id_type: pa.DataType) -> list[pa.Array]:
    """Result columns of documents whose successors are known."""
    edited = [replace_end(a, b).encode() for a, b in zip(own, following, strict=True)]
    mine = codes([t.encode() for t in own])
    changed = codes(edited)
    # successors mostly are the next rows of the same list
    after = mine[1:] if own[1:] == following[:-1] else codes([t.encode() for t in following[:-1]])
    after = np.concatenate([after, codes([t.encode() for t in following[-1:]])])
    return [pa.array(ids, type=id_type), pa.array([len(t) for t in own], type=pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for t in edited], type=pa.string()),
            pa.array(to_hex(mine), type=pa.string()), pa.array(to_hex(changed), type=pa.string()),
            pa.array(likeness(mine, changed)), pa.array(likeness(mine, after))]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
          "near_edited", "near_next"]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition -> finished rows, and its first and last row with their texts."""
    part = TaskContext.get().partitionId()
    held_id, held_text, id_type = [], [], None

    def loose(kind: int) -> pa.RecordBatch:
        empty = [pa.array([0], type=pa.int64()), *(pa.array([""]) for _ in range(3)),
                 *(pa.array([0.0]) for _ in range(2))]
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], type=pa.int32()), pa.array([part], type=pa.int32()),
             pa.array([held_text[0]], type=pa.string()), pa.array([held_id[0]], type=id_type), *empty],
            names=["kind", "part", "text", *_NAMES])

    for whole in batches:
        # small steps bound what is held besides the batch itself
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            id_type = batch.column(0).type
            ids = [*held_id, *batch.column(0).to_pylist()]
            own = [*held_text, *batch.column(1).to_pylist()]
            if not held_id:
                held_id, held_text = ids[:1], own[:1]
                yield loose(_HEAD)
            if len(ids) > 1:
                n = len(ids) - 1
                columns = _rows(ids[:-1], own[:-1], own[1:], id_type)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_CLOSED] * n, type=pa.int32()), pa.array([part] * n, type=pa.int32()),
                     pa.nulls(n, pa.string()), *columns], names=["kind", "part", "text", *_NAMES])
            held_id, held_text = ids[-1:], own[-1:]
    if held_id:
        yield loose(_OPEN)


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            ids, own, following = (batch.column(i) for i in range(3))
            rows = [_rows([i], [a], [b], ids.type) for i, a, b in
                    zip(ids.to_pylist(), own.to_pylist(), following.to_pylist(), strict=True)]
            yield from (pa.RecordBatch.from_arrays(r, names=_NAMES) for r in rows)


def successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest of each document, of its text with the last third replaced by the start of the
    next document (descending id, ties by text hash; the first follows the last), and the
    likeness of the digest to the edited text's and to the next document's."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.col("_hash").asc()]
    rows = (docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"),
                        text_hash(text_col).alias("_hash"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    result = RESULT.format(id=id_type)
    done = cut(rows.mapInArrow(_stream, f"kind int, part int, text string, {result}"), "digest")
    # one number per non-empty partition: what the driver knows of any job
    parts = sorted(r[0] for r in done.where(F.col("kind") == _HEAD).select("part").collect())
    pairs = spark.createDataFrame([(p, q) for p, q in zip(parts, parts[1:] + parts[:1], strict=True)],
                                  "part int, after int")
    ends = (done.where(F.col("kind") == _OPEN).select("part", "doc_id", "text").join(pairs, "part")
            .join(done.where(F.col("kind") == _HEAD)
                  .select(F.col("part").alias("after"), F.col("text").alias("following")), "after")
            .select("doc_id", "text", "following").mapInArrow(_join_ends, result))
    return done.where(F.col("kind") == _CLOSED).select(*_NAMES).unionByName(ends)
