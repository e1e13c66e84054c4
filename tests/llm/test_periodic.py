"""op13: runs against a comparison of every word with every later one."""

import random

import edge
import numpy as np
import pytest
from edge import edge_dir, empty_dir  # noqa: F401  (fixtures)

from urbanpulse.llm import periodic, words
from urbanpulse.llm.queries import QUERIES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edge(spark, edge_dir):
    got = rows(QUERIES["op13_periodic"](spark, edge_dir))
    short = [r for r in edge.documents() if len(r[1] or "") < 20_000]
    want = edge.periodic_rows(short)
    ids = {r[0] for r in edge.documents()} - {r[0] for r in short}
    assert [r for r in got if r[0] not in ids] == want
    assert any(r[1] for r in want)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = edge.periodic_rows([r for r in given if len(r[1] or "") < 12_000])
    ids = {r[0] for r in want}
    got = [r for r in rows(QUERIES["op13_periodic"](spark, sf)) if r[0] in ids]
    assert got == want and sum(r[1] > 0 for r in want) > 10


@pytest.mark.parametrize("least,times", [(24, 3), (6, 3), (2, 2), (5, 2)])
def test_random(least, times):
    rng = random.Random(least * times)
    split = []
    for _ in range(150):
        w: list[bytes] = []
        while len(w) < rng.randint(0, 120):
            base = [rng.choice([b"a", b"b", b"c", b"dd"]) for _ in range(rng.randint(1, 12))]
            w += (base * rng.randint(1, 8))[:rng.randint(1, 60)]
        split.append(w)
    got = periodic.runs_of(split, least, times)
    assert [[(s, e - s, q) for s, e, q in r] for r in got] == [edge.runs(w, least, times) for w in split]
    for w, found in zip(split, got, strict=True):
        gone = {i for s, e, q in found for i in range(s + q, e)}
        assert periodic.collapse(w, found) == [x for i, x in enumerate(w) if i not in gone]


def test_suffix_arrays(monkeypatch):
    monkeypatch.setattr(periodic, "LOOKUPS", 7)
    rng = random.Random(2)
    for n in (1, 2, 9, 60, 200):
        w = np.array([rng.randint(1, 3) for _ in range(n)] + [0])
        order, rank = periodic.suffix_order(w)
        want = sorted(range(n + 1), key=lambda i: w[i:].tolist())
        assert order.tolist() == want and [want[k] for k in rank] == list(range(n + 1))
        lcp = periodic.common_prefixes(w, order, rank)

        def common(i, j):
            return next(k for k in range(n + 1) if w[i + k] != w[j + k])

        assert lcp.tolist() == [0, *(common(a, b) for a, b in zip(want, want[1:], strict=False))]
        start, period = periodic.tandems(order, rank, lcp)
        squares = {(i, d) for d in range(1, n + 1) for i in range(n + 1 - 2 * d) if common(i, i + d) == d}
        assert set(zip(start.tolist(), period.tolist(), strict=True)) == squares


def test_one_word_for_ever():
    """A very long run has one period, however many squares it holds."""
    w = [b"x"] * 200_000
    assert periodic.runs_of([w, [b"y"], w[:23]]) == [[(0, 200_000, 1)], [], []]


def test_interface(spark, monkeypatch):
    monkeypatch.setattr(words, "CHUNK_BYTES", 30)
    docs = [(1, "a b " * 12 + "c", "s"), (2, None, "s"), (3, "", "s"), (1, "a b " * 12 + "c", "s"), (None, "p\tq\n" * 30, "s")]
    found = periodic.find_runs(edge.frame(spark, docs))
    assert found.columns == [*(c for c in edge.frame(spark, docs).columns if c != "n_words"), "n_words", "runs", "collapsed"]
    got = sorted(((r["doc_id"], r["text"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()), key=str)
    assert got == sorted([(1, docs[0][1], [(0, 24, 2)], "a b c")] * 2 + [(2, None, [], ""), (3, "", [], ""),
                         (None, docs[4][1], [(0, 60, 2)], "p q")], key=str)
    with pytest.raises(ValueError):
        periodic.find_runs(edge.frame(spark, docs), min_exponent=1)
