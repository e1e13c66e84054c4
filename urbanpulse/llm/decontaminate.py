"""Benchmark decontamination by a broadcast hash set of test n-grams.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.
A window is ``n`` consecutive words of a benchmark item; an item with fewer
words (but some) is one window.  Every token window of every document is looked
up by hash; a hit of the hash set is verified word by word.  Words inside an
occurrence are hit; hit spans can be cut out or hit documents removed.

Size of the broadcast
---------------------
The benchmark's bytes are counted first.  Up to ``slice_bytes`` of it make one
hash set; a larger benchmark is cut into as many slices as it needs, and the
documents pass over one slice after the other, each set bounded by
``slice_bytes``.  Nothing is shuffled.

Nulls, empty texts: no words, no hits.  Items without an id or without words
are ignored; items that share an id count once.  Repeated documents are judged
alike.  An empty benchmark hits nothing; an empty table gives an empty result.
Extra columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, seal, texts, whole_text

SLICE_BYTES = 32 << 20
_TABLE_BITS = 22
# Every byte that is no part of a word becomes a space; A-Z become a-z.
_WORD_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122
                    or b >= 128 else 32 for b in range(256))
FOUND = "n_words long, hit array<struct<start:long,end:long>>, items array<string>"


def words(data: bytes) -> list[bytes]:
    return data.translate(_WORD_BYTES).split()


class NGramSet:
    """Hash set over the windows of some benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, text in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(text)]
            size = min(n, len(w))
            if not size:
                continue
            of = self.windows.setdefault(size, {})
            for i in range(len(w) - size + 1):
                of.setdefault(tuple(w[i:i + size]), set()).add(number[item])
        rng = np.random.default_rng(20)
        self.factors = rng.integers(1, 1 << 63, size=max([*self.windows, 1]), dtype=np.uint64) * 2 + 1
        self.tables = {}
        for size, of in self.windows.items():
            table = np.zeros(1 << _TABLE_BITS, dtype=bool)
            keys = np.array(list(of), dtype=np.uint64).reshape(-1, size)
            table[self._slots([keys[:, j] for j in range(size)])] = True
            self.tables[size] = table

    def _slots(self, columns: list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(columns[0]), dtype=np.uint64)
        for x, factor in zip(columns, self.factors, strict=False):
            total += x * factor
        total ^= total >> np.uint64(29)
        total *= np.uint64(0x9E3779B97F4A7C15)
        return total >> np.uint64(64 - _TABLE_BITS)

    def scan(self, token_ids: np.ndarray):
        """(position, size, items) of each verified window."""
        for size, table in self.tables.items():
            count = len(token_ids) - size + 1
            if count < 1:
                continue
            slots = self._slots([token_ids[j:j + count] for j in range(size)])
            of = self.windows[size]
            for p in np.flatnonzero(table[slots]).tolist():
                if (items := of.get(tuple(token_ids[p:p + size].tolist()))) is not None:
                    yield p, size, items


def _scanner(grams: NGramSet, first: bool):
    get = grams.vocabulary.get

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            n = batch.num_rows
            split = [words(t) for t in texts(batch.column(batch.schema.get_field_index("_text")))]
            sizes = np.fromiter(map(len, split), dtype=np.int64, count=n)
            # one 0 between documents: no window that crosses them can be verified
            starts = np.r_[0, np.cumsum(sizes + 1)]
            ids = np.zeros(int(starts[-1]), dtype=np.uint64)
            for k, w in enumerate(split):
                ids[starts[k]:starts[k] + len(w)] = [get(x, 0) for x in w]
            del split
            edge = np.zeros(len(ids) + 1, dtype=np.int64)
            items: dict[int, set[str]] = {}
            for p, size, of in grams.scan(ids):
                edge[p] += 1
                edge[p + size] -= 1
                items.setdefault(int(np.searchsorted(starts, p, "right")) - 1, set()).update(
                    grams.ids[i] for i in of)
            if not first:
                old_spans = batch.column(batch.schema.get_field_index("hit")).to_pylist()
                old_items = batch.column(batch.schema.get_field_index("items")).to_pylist()
                for k in range(n):
                    for s in old_spans[k]:
                        edge[starts[k] + s["start"]] += 1
                        edge[starts[k] + s["end"]] -= 1
                    if old_items[k]:
                        items.setdefault(k, set()).update(old_items[k])
            hit = np.cumsum(edge)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
            spans: list[list] = [[] for _ in range(n)]
            for a, b in turn.reshape(-1, 2).tolist():
                k = int(np.searchsorted(starts, a, "right")) - 1
                spans[k].append({"start": a - int(starts[k]), "end": b - int(starts[k])})
            keep = [f for f in batch.schema.names if f not in ("n_words", "hit", "items")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(f)) for f in keep), pa.array(sizes),
                 pa.array(spans, type=kinds),
                 pa.array([sorted(items.get(k, ())) for k in range(n)], type=pa.list_(pa.string()))],
                names=[*keep, "n_words", "hit", "items"])

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", n: int = 10,
               slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit`` (runs of hit words: start, end) and ``items``.

    Columns of ``docs`` with these names are replaced.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             whole_text(item_text_col).alias("text")).where("item is not null and text <> ''")
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    slices = max(1, math.ceil(size / slice_bytes))
    docs, (text_col,), unseal = seal(docs, text_col)
    rows = docs.withColumn("_text", whole_text(text_col))
    for k in range(slices):
        # at most about slice_bytes: the hash deals items evenly
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k).distinct().collect()
        grams = NGramSet([(r["item"], r["text"].encode()) for r in part], n)
        kept = [f for f in rows.schema if f.name not in ("n_words", "hit", "items")]
        schema = T.StructType([*kept, *T._parse_datatype_string(FOUND).fields])
        rows = rows.mapInArrow(_scanner(grams, k == 0), schema)
        if k + 1 < slices:
            rows = cut(rows, "leaks")
    return unseal(rows, "n_words", "hit", "items")


def n_hit_words(hit: str = "hit"):
    return F.aggregate(hit, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` without a hit."""
    names = docs.columns
    sealed, _, unseal = seal(docs)
    settings["text_col"] = f"_c{names.index(settings.get('text_col', 'text'))}"
    return unseal(find_leaks(sealed, benchmark, **settings).where(F.size("hit") == 0))


def cut_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with hit words removed from the text, from the first to the last of each run.

    A line feed takes the place of a run, so that no new window can arise.  Texts
    without a hit are unchanged.
    """
    docs, (text_col,), unseal = seal(docs, text_col)
    found = find_leaks(docs, benchmark, text_col=text_col, **settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        word = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            spans = batch.column(batch.schema.get_field_index("hit")).to_pylist()
            out = []
            for data, of, is_null in zip(texts(batch.column(at)), spans,
                                         batch.column(at).is_null().to_pylist(), strict=True):
                if of:
                    place = [m.span() for m in word.finditer(data)]
                    pieces, last = [], 0
                    for s in of:
                        pieces.append(data[last:place[s["start"]][0]])
                        last = place[s["end"] - 1][1]
                    data = b"\n".join([*pieces, data[last:]])
                out.append(None if is_null else data.decode())
            columns = [*batch.columns]
            columns[at] = pa.array(out, type=batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return unseal(found.mapInArrow(run, found.schema))
