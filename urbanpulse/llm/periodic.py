"""Periodic runs of words, by an enhanced suffix array and the branching-tandem test.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), of ``min_length`` words and ``min_exponent`` periods or more, that no
neighbouring word extends.

A text's words are numbered, and its suffix array, inverse (ISA) and longest-common-
prefix array (LCP) are built; texts of a chunk share arrays, with numbers and an end
mark of their own.  An LCP entry of depth d divides the suffixes of its interval in two.
For every suffix i of the smaller part it is looked up by the ISA whether i + d or i - d
lies in the other part: then d words from the smaller of the two on are followed by
the same d words, and the word after these breaks the repetition (a branching tandem
repeat).  Each suffix is in the smaller part a logarithmic number of times.  The other
squares of a run are rotations of its branching one: going left while words d apart are
equal leads to the start of the run.  Tandems of a multiple of a run's period end where the
run ends and are merged into it.  No tree is built; only the array of depths is walked.

A run of length L and period q repeats a window of L - q words, which has
``min_length - min_length // min_exponent`` words or more.  A text in which no window of
so many words occurs twice has no run and needs no suffix array: the test loses nothing.

Null and empty texts have no words and no runs.  Texts are taken whole; the memory of a
task follows its longest text.  Rows are taken one by one (repeated rows and ties of an
id are alike).  An empty table gives an empty result.  Extra columns stay; columns named
like results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import seal
from .words import chunks, number_words, repeated_windows

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Suffixes looked up at a time.
LOOKUPS = 1 << 21
Run = tuple[int, int, int]  # start, end, period


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and inverse of a sequence whose last element is unique, by prefix doubling.

    A suffix's rank is the place of the first of its group; only suffixes whose rank is
    shared are sorted again.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    first = np.r_[True, words[order[1:]] != words[order[:-1]]]
    place = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, place, 0))
    open_ = np.sort(order[~(first & np.r_[first[1:], True])])
    step = 1
    while len(open_):
        own, ahead = rank[open_], rank[open_ + step]
        by = np.lexsort((ahead, own))
        at, own, ahead = open_[by], own[by], ahead[by]
        group = np.r_[True, own[1:] != own[:-1]]
        new = group | np.r_[True, ahead[1:] != ahead[:-1]]
        place = np.arange(len(at))
        rank[at] = own + (np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0)))
        open_ = np.sort(at[~(new & np.r_[new[1:], True])])
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order, rank


def common_prefixes(words: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """LCP[k]: common words of the suffixes at k - 1 and k in the order; LCP[0] is 0."""
    n = len(words)
    out = np.zeros(n, dtype=np.int64)
    w, sa, isa, lcp = (memoryview(np.ascontiguousarray(x)) for x in (words, order, rank, out))
    size = 0
    for i in range(n):
        k = isa[i]
        if k == 0:
            size = 0
            continue
        j = sa[k - 1]
        # the unique last element ends every comparison
        while w[i + size] == w[j + size]:
            size += 1
        lcp[k] = size
        if size:
            size -= 1
    return out


def parts(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each LCP entry k: the part [left, k) and the part [k, right) that it divides."""
    n = len(lcp)
    left, right = np.zeros(n, dtype=np.int64), np.full(n, n, dtype=np.int64)
    depth, lo, hi = memoryview(lcp), memoryview(left), memoryview(right)
    open_: list[int] = []
    for k in range(1, n):
        d = depth[k]
        while open_ and depth[open_[-1]] >= d:
            hi[open_.pop()] = k
        lo[k] = open_[-1] if open_ else 0
        open_.append(k)
    return left, right


def tandems(order: np.ndarray, rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every branching tandem repeat."""
    left, right = parts(lcp)
    k = np.flatnonzero(lcp > 0)
    left, right, depth = left[k], right[k], lcp[k]
    lefter = k - left <= right - k
    lo, hi = np.where(lefter, left, k), np.where(lefter, k, right)  # the smaller part
    other_lo, other_hi = np.where(lefter, k, left), np.where(lefter, right, k)
    n, size = len(order), hi - lo
    upto = np.cumsum(size)
    starts, periods = [], []
    a = 0
    while a < len(k):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + LOOKUPS, side="right")))
        many = size[a:b]
        node = np.repeat(np.arange(a, b), many)
        row = np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many)
        i, d = order[lo[node] + row], depth[node]
        for j in (i + d, i - d):
            inside = (j >= 0) & (j < n)
            place = rank[np.where(inside, j, 0)]
            hit = inside & (place >= other_lo[node]) & (place < other_hi[node])
            starts.append(np.minimum(i, j)[hit])
            periods.append(d[hit])
        a = b
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def _run_start(words: np.ndarray, at: int, period: int) -> int:
    """Where the run of a square at ``at`` starts."""
    step = 64
    while at > 0:
        a = max(0, at - step)
        differ = np.flatnonzero(words[a:at] != words[a + period:at + period])
        if len(differ):
            return a + int(differ[-1]) + 1
        at, step = a, step * 2
    return 0


def merge_runs(words: np.ndarray, start: np.ndarray, period: np.ndarray, min_length: int, min_exponent: int) -> list[Run]:
    """The runs that the branching tandems belong to, rotated to their start, by start and period."""
    # words to the left that a run long enough must have; eight of them are tested at once
    need = np.maximum(min_length, min_exponent * period) - 2 * period
    for back in range(1, 9):
        if not len(start):
            break
        i = np.maximum(start - back, 0)
        stays = (need < back) | ((start >= back) & (words[i] == words[i + period]))
        start, period, need = start[stays], period[stays], need[stays]
    end = start + 2 * period
    by = np.lexsort((period, end))
    end, period = end[by], period[by]
    found: list[Run] = []
    if not len(end):
        return found
    cuts = np.flatnonzero(np.r_[True, end[1:] != end[:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(end)], strict=True):
        e, left = int(end[a]), period[a:b]
        while len(left):
            q = int(left[0])
            s = _run_start(words, e - 2 * q, q)
            if e - s >= max(min_length, min_exponent * q):
                found.append((s, e, q))
            left = left[1:]
            left = left[~((left % q == 0) & (2 * left <= e - s))]
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(split: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[Run]]:
    """The runs of each text of a chunk, given as lists of words."""
    out: list[list[Run]] = [[] for _ in split]
    ids, starts = number_words(split)
    twice = repeated_windows(ids, starts, max(1, min_length - min_length // min_exponent))
    some = np.unique(np.searchsorted(starts, twice, side="right") - 1)
    if not len(some):
        return out
    sizes = np.diff(starts)[some]
    offset = np.cumsum(sizes + 1) - (sizes + 1)
    words = np.empty(int((sizes + 1).sum()), dtype=np.int64)
    span = int(ids.max()) + 2
    for k, (doc, a) in enumerate(zip(some.tolist(), offset.tolist(), strict=True)):
        n = int(sizes[k])
        words[a:a + n] = ids[starts[doc]:starts[doc + 1]] + (k * span + 1)
        words[a + n] = k * span  # the end mark of the text
    order, rank = suffix_order(words)
    found = merge_runs(words, *tandems(order, rank, common_prefixes(words, order, rank)), min_length, min_exponent)
    for s, e, q in found:
        k = int(np.searchsorted(offset, s, side="right")) - 1
        a = int(offset[k])
        out[some[k]].append((s - a, e - a, q))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds beyond its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for s, e, q in runs:
        edge[s + q] += 1
        edge[e] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` is the text's words without the repeated periods, joined by one space.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words or more")
    docs, (text_col,), unseal = seal(docs, text_col)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            row = 0
            for found in chunks(column):
                split = [t.split() for t in found]
                runs = runs_of(split, min_length, min_exponent)
                short = [b" ".join(collapse(w, r)) for w, r in zip(split, runs, strict=True)]
                told = [[{"start": s, "length": e - s, "period": q} for s, e, q in r] for r in runs]
                same = batch.slice(row, len(found))
                row += len(found)
                yield pa.RecordBatch.from_arrays(
                    [*same.columns, pa.array([len(w) for w in split], pa.int64()), pa.array(told, run_type),
                     pa.array(short, pa.binary()).cast(pa.string())],
                    names=[*batch.schema.names, "n_words", "runs", "collapsed"])

    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(
        "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string").fields])
    return unseal(docs.mapInArrow(run, schema), "n_words", "runs", "collapsed")


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period."""
    return F.expr(f"""get(array_sort({runs}, (a, b) -> CASE
        WHEN a.length * b.period > b.length * a.period THEN -1 WHEN a.length * b.period < b.length * a.period THEN 1
        WHEN a.start < b.start THEN -1 WHEN a.start > b.start THEN 1
        WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END), 0)""")
