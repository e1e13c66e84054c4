"""The pipeline against plain Python, stage by stage on its own input."""

import corpus_pipeline
import edge
import pytest
from edge import edge_dir, empty_dir  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from urbanpulse.llm import mixing, quality
from urbanpulse.llm.common import table


def by_hand(spark, sf_dir, rows, bench):
    """(doc_id, text, source) rows that the first four stages keep."""
    docs = edge.frame(spark, rows)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    good = {(r["doc_id"], r["text"]) for r in docs.where(quality.score(model) >= 0.7).select("doc_id", "text").collect()}
    rows = [r for r in rows if (r[0], r[1]) in good]
    done = edge.line_texts(rows)
    rows = [(d, t if not done[d, t or ""][1] else done[d, t or ""][3], s) for d, t, s in rows
            if not done[d, t or ""][1] or done[d, t or ""][1] < done[d, t or ""][0]]
    root = edge.components([edge.simhash(t) for _, t, _ in rows])
    first = {}
    for d, t, s in rows:
        rank = (d is not None, d or 0, edge.text_hash(t))
        key = root[edge.simhash(t)]
        if key not in first or rank < first[key][0]:
            first[key] = (rank, (d, t, s))
    rows = [r for _, r in first.values()]
    leaks = edge.leak_rows(rows, bench)
    bad = {x[0] for x in leaks if x[5]}
    return [r for r in rows if r[0] not in bad]


@pytest.fixture(scope="module")
def done(spark, edge_dir):
    return corpus_pipeline.run(spark, edge_dir)


def test_run_equals_plain_python(spark, edge_dir, done):
    want = by_hand(spark, edge_dir, edge.documents(), edge.benchmark())
    got = [(r["doc_id"], r["text"], r["source"]) for r in done.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    docs = edge.frame(spark, want)
    plan = {(r["doc_id"], r["text_hash"]): r["slot"] for r in mixing.schedule(docs).collect()}
    assert {(r["doc_id"], r["slot"]) for r in done.collect()} == {
        (d, plan[d, edge.text_hash(t)]) for d, t, _ in want}


def test_characters_follow_the_text(done):
    assert done.where(F.coalesce(F.col("n_chars"), F.lit(0)) != F.length(F.coalesce("text", F.lit("")))).count() == 0


def test_stages_return_document_columns(spark, edge_dir):
    docs = table(spark, edge_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, edge_dir).columns == docs.columns


def test_empty(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
