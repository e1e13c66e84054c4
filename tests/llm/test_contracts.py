"""Every registered query over a table with all awkward cases, against plain Python."""

import glob
import random

import duckdb
import edge
import pytest
from edge import edge_dir, empty_dir  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from urbanpulse.llm import (common, decontaminate, digest, licenses, lines, mixing, quality, secret_field, simhash, suffixes,
                            tokens)
from urbanpulse.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_licenses": ["doc_id", "sentence_ids", "licenses", "n_unknown"],
    "op2_mixing": ["doc_id", "mix_source", "block", "release", "deadline", "slot", "offset", "in_mix"],
    "op3_suffixes": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op6_lines": ["doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256"],
    "op7_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_tokens": ["doc_id", "n_chars", "n_tokens"],
    "op9_digest": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_quality": ["doc_id", "held_out", "score", "predicted"],
    "op11_conversations": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                   "failed"],
    "op13_periodic": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, empty_dir, name):
    got = QUERIES[name](spark, empty_dir)
    assert got.columns == COLUMNS[name]
    assert got.count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_parity(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got[columns].astype(str).values)) == sorted(map(tuple, want[columns].astype(str).values))


# --- op1 ------------------------------------------------------------------------

LICENSED = [
    ("Released under the MIT License.", "MIT-REF", "MIT"),
    ("Licensed under the Apache License, Version 2.0.", "APACHE:2.0", "Apache-2.0"),
    ("Licensed under CC BY-NC 4.0.", "CC:by-nc 4.0", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL:3", "GPL-3.0"),
    (" * Licensed under the Apache Licence, Version 2.0 (the \"License\");\n"
     " * you may not use this file except in compliance with the License.\n"
     " * You may obtain a copy of the License at\n *     http://www.apache.org/licenses/LICENSE-2.0",
     "APACHE:2.0,APACHE-NOTICE,APACHE-COPY,APACHE-URL", "Apache-2.0"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
     " the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice."
     "\n2. Redistributions in binary form must reproduce the above copyright notice.",
     "BSD-GRANT,BSD-SOURCE,BSD-BINARY", "BSD-2-Clause"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted.\n"
     "Redistributions of source code must retain the above copyright notice.\nRedistributions in binary form must"
     " reproduce the above copyright notice.\nNeither the name of X nor of Y may be used.",
     "BSD-GRANT,BSD-SOURCE,BSD-BINARY,BSD-NAME", "BSD-3-Clause"),
    ("We like licences.\nNothing else.", "?", ""),
    ("SPDX-License-Identifier: MIT\nReleased under the MIT License.", "SPDX:mit,MIT-REF", "MIT,SPDX"),
    ("no such words", "", ""), ("", "", ""), (None, "", ""),
]


def test_licenses(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(LICENSED)], "doc_id int, text string")
    got = licenses.scan(docs).orderBy("doc_id").collect()
    assert [",".join(r["sentence_ids"]) for r in got] == [x[1] for x in LICENSED]
    assert [",".join(r["licenses"]) for r in got] == [x[2] for x in LICENSED]


def test_licenses_native(spark):
    plan = QUERIES["op1_licenses"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_licenses_edge(spark, edge_dir):
    got = {r["doc_id"]: r for r in QUERIES["op1_licenses"](spark, edge_dir).collect()}
    assert got[20]["sentence_ids"] == "MIT-REF,COPYRIGHT" and got[20]["licenses"] == "MIT"
    assert len(rows(QUERIES["op1_licenses"](spark, edge_dir))) == len(edge.documents())


# --- op2 ------------------------------------------------------------------------

@pytest.mark.parametrize("weights", [mixing.WEIGHTS, {"a": 0.5, "*": 0.5}, {"a": 1, "b": 2, "c": 4, "*": 0.01}, {"*": 1}])
def test_pfair_lag(weights):
    share = mixing.shares(weights)
    had = dict.fromkeys(share, 0)
    for t, (s, j) in enumerate(mixing.period(share)):
        assert had[s] == j
        had[s] += 1
        assert all(abs(had[x] - share[x] * (t + 1) / mixing.SLOTS) < 1 for x in share)
    assert had == share


def test_mixing_edge(spark):
    docs = edge.frame(spark, edge.documents())
    weights = {"src0": 0.6, "src1": 0.1, "*": 0.3}
    plan = mixing.schedule(docs, weights, block_chars=200)
    got = plan.collect()
    assert len(got) == len(edge.documents())
    for r in got:
        assert r["release"] <= r["slot"] < r["deadline"]
    for s in {r["mix_source"] for r in got}:
        own = sorted((r for r in got if r["mix_source"] == s), key=lambda r: (r["offset"], r["slot"]))
        assert [r["block"] for r in own] == [r["offset"] // 200 for r in own]
    mixed = mixing.mix(docs, weights, block_chars=200)
    assert mixed.count() == len(edge.documents())
    assert mixed.columns == [c for c in docs.columns if c not in ("slot", "mix_source")] + [
        "mix_source", "slot", "mix_offset", "in_mix"]
    assert {r[0] for r in mixed.where("source is null").select("mix_source").collect()} == {"*"}


@pytest.mark.parametrize("copies", [3, 500])
def test_every_equal_row_has_its_place(spark, scratch_dir, monkeypatch, copies):
    """Rows equal in id, text and source, null ids and one id with many texts: as the SQL has them."""
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 7)
    text = "x" * 300
    docs = [(1, text, "src0")] * copies + [(2, "y" * 70_000, "src0"), (3, text, "src1"), (3, text, "src1")] + [
        (None, f"{k} none", "src2") for k in range(20)] + [(4, f"{k} many", "src2") for k in range(20)] + [(5, None, None), (5, "", None)]
    edge.frame(spark, docs).write.parquet(f"{scratch_dir}/documents.parquet")
    got = QUERIES["op2_mixing"](spark, scratch_dir)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{scratch_dir}/documents.parquet/*.parquet'")
    want = con.sql(f"""select {', '.join(f'"{c}"' for c in got.columns)} from ({SQL["op2_mixing"]})""").fetchall()
    assert rows(got) == sorted(want, key=str) and len(want) == len(docs)
    assert mixing.mix(edge.frame(spark, docs)).count() == len(docs)


def test_mix_keeps_rows_of_two_sources(spark):
    """Rows equal in id and text under two sources of the weights each stay once, with their own."""
    docs = edge.frame(spark, [(1, "same text", "src0"), (1, "same text", "src1"), (2, "own", "src0"),
                              (3, "twin", "x"), (3, "twin", "y"), (4, "none", None)])
    mixed = mixing.mix(docs, {"src0": 0.6, "src1": 0.1, "*": 0.3}, block_chars=4, slots=20)
    got = sorted((r["doc_id"], r["source"] or "", r["mix_source"]) for r in mixed.collect())
    assert got == [(1, "src0", "src0"), (1, "src1", "src1"), (2, "src0", "src0"), (3, "x", "*"), (3, "y", "*"), (4, "", "*")]


# --- op3 ------------------------------------------------------------------------

def test_suffixes_edge(spark, edge_dir):
    assert rows(QUERIES["op3_suffixes"](spark, edge_dir)) == edge.suffix_rows(edge.documents(), 100)


@pytest.mark.parametrize("length,chunk", [(16, 1 << 19), (21, 64), (40, 200)])
def test_suffixes_random(spark, monkeypatch, length, chunk):
    monkeypatch.setattr(suffixes, "_CHUNK", chunk)
    rng = random.Random(length)
    shared = ["".join(rng.choice("abc é") for _ in range(n)) for n in (15, 30, 60, 150)]
    docs = [(i, "".join(rng.choice([*shared, "x", "".join(rng.choice("ab") for _ in range(9)), "a" * 50])
                        for _ in range(rng.randint(0, 9))), "s") for i in range(60)]
    found = suffixes.remove_repeats(edge.frame(spark, docs), length=length)
    n = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    got = rows(found.select("doc_id", F.octet_length("text").cast("long"), n, F.size("removed").cast("long"),
                            F.sha2("kept", 256)))
    assert got == edge.suffix_rows(docs, length)


# --- op4 ------------------------------------------------------------------------

def test_simhash_edge(spark, edge_dir):
    assert rows(QUERIES["op4_simhash"](spark, edge_dir)) == edge.simhash_rows(edge.documents())


@pytest.mark.parametrize("bits,group", [(3, 4), (3, 1024), (1, 3), (2, 8)])
def test_simhash_links(spark, bits, group):
    rng = random.Random(bits)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randint(0, 63)
            prints.add(x)
    prints |= {0, (1 << 64) - 1, 1 << 63, (1 << 63) | 1}
    df = spark.createDataFrame([(edge.signed(p),) for p in prints], "fp long")
    linked = {r["node"]: r["root"] for r in simhash.components(simhash.link_forest(df, bits, group)).collect()}
    got, want = {}, {}
    for p in prints:
        got.setdefault(linked.get(edge.signed(p), edge.signed(p)), set()).add(p)
    for p, r in edge.components(list(prints), bits).items():
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in
           simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1080), 1000)}


def test_keep_one(spark):
    docs = edge.documents()
    kept = simhash.keep_one(edge.frame(spark, docs))
    assert kept.columns == edge.frame(spark, docs).columns
    root = edge.components([edge.simhash(t) for _, t, _ in docs])
    got = sorted(root[edge.simhash(r["text"])] for r in kept.collect())
    assert got == sorted(set(root.values()))


# --- op5 ------------------------------------------------------------------------

def test_leaks_edge(spark, edge_dir):
    assert rows(QUERIES["op5_decontaminate"](spark, edge_dir)) == edge.leak_rows(edge.documents(), edge.benchmark())


def test_leaks_in_slices(spark):
    docs, bench = edge.documents(), spark.createDataFrame(edge.benchmark(), "item_id long, text string")
    found = decontaminate.find_leaks(edge.frame(spark, docs), bench, slice_bytes=80)
    hit = decontaminate.n_hit_words()
    got = rows(found.select("doc_id", "n_words", hit, F.size("items").cast("long"),
                            F.sha2(F.concat_ws(",", "items"), 256), hit > 0))
    assert got == edge.leak_rows(docs, edge.benchmark())


def test_leaks_removed(spark):
    docs, bench = edge.documents(), spark.createDataFrame(edge.benchmark(), "item_id long, text string")
    df = edge.frame(spark, docs)
    clean = [x[0] for x in edge.leak_rows(docs, edge.benchmark()) if not x[5]]
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(clean, key=str)
    cut = decontaminate.cut_spans(df, bench)
    assert cut.columns == df.columns and cut.count() == len(docs)
    assert decontaminate.drop_contaminated(cut, bench).count() == len(docs)
    before = {(d, t) for d, t, _ in docs}
    assert {(r["doc_id"], r["text"]) for r in cut.collect() if r["doc_id"] in clean} <= before


# --- op6 ------------------------------------------------------------------------

def test_lines_edge(spark, edge_dir):
    want = edge.line_texts(edge.documents())
    want = sorted(((d, a, b, c, edge.sha(k.encode())) for d, t, _ in edge.documents()
                   for a, b, c, k in [want[d, t or ""]]), key=str)
    assert rows(QUERIES["op6_lines"](spark, edge_dir)) == want
    assert any(x[2] for x in want)
    assert next(x[2] for x in want if x[0] == 25) == 3  # the run's short and empty lines, too


def grown(spark, folder, monkeypatch, docs, copies, operator):
    """Rows of the intermediate tables that an operator writes for so many copies of each of ``docs``."""
    monkeypatch.setattr(common, "shared_folder", lambda _: folder)
    found = operator(edge.frame(spark, [d for d in docs for _ in range(copies)])).collect()
    assert len(found) == copies * len(docs)
    counts = {}
    for path in glob.glob(f"{folder}/*"):
        name = path.rsplit("/", 1)[1].rsplit("-", 1)[0]
        counts[name] = counts.get(name, 0) + (spark.read.parquet(path).count() if glob.glob(f"{path}/part-*") else 0)
    return counts


@pytest.mark.parametrize("operator", [lambda df: lines.dedup_lines(df), lambda df: suffixes.remove_repeats(df, length=40)])
def test_equal_rows_are_ranked_once(spark, scratch_dir, monkeypatch, operator):
    """Copies of one (id, text) add nothing to the tables in between."""
    text = "\n".join(edge.words(random.Random(k), 12) for k in range(12))
    docs = [(1, text, "s"), (2, text + "\nend", "s"), (3, edge.words(random.Random(77), 60), "s")]
    few, many = (grown(spark, f"{scratch_dir}/{n}", monkeypatch, docs, n, operator) for n in (2, 40))
    assert few == many and few["one-of-each"] == 3


@pytest.mark.parametrize("min_words", [1, 3, 7, 20])
def test_lines_random(spark, min_words):
    rng = random.Random(min_words)
    pool = ["", " ", "a", "b c", "d e f", "g  h ", " g  h", "i j k l m n o p"]
    block = [rng.choice(pool) for _ in range(30)]
    docs = []
    for i in range(40):
        at = rng.randint(0, 25)
        docs.append((i % 37, "\n".join([*(rng.choice(pool) for _ in range(rng.randint(0, 6))),
                                       *block[at:at + rng.randint(0, 20)]]), "s"))
    found = lines.dedup_lines(edge.frame(spark, docs), min_words=min_words, whole_runs=False)
    got = rows(found.select("doc_id", "n_lines", lines.n_removed(), F.size("removed"), "text"))
    want = edge.line_texts(docs, min_words, forward_only=True)
    assert got == sorted(((d, *want[d, t]) for d, t, _ in docs), key=str)


@pytest.mark.parametrize("min_words", [1, 3, 7, 20])
def test_lines_whole_runs_random(spark, min_words):
    rng = random.Random(min_words + 50)
    pool = ["", " ", "a", "b c", "d e f", "g  h ", " g  h", "i j k l m n o p", "q r s t u v w x y z " * 3]
    block = [rng.choice(pool) for _ in range(30)]
    docs = []
    for i in range(40):
        at = rng.randint(0, 25)
        docs.append((i, "\n".join([*(rng.choice(pool) for _ in range(rng.randint(0, 6))),
                                  *block[at:at + rng.randint(0, 20)]]), "s"))
    found = lines.dedup_lines(edge.frame(spark, docs), min_words=min_words, whole_runs=True)
    want = edge.line_texts(docs, min_words)
    got = rows(found.select("doc_id", "n_lines", lines.n_removed(), F.size("removed"), "text"))
    assert got == sorted(((d, *want[d, t]) for d, t, _ in docs), key=str)
    forward = edge.line_texts(docs, min_words, forward_only=True)
    assert min_words == 1 or sum(x[1] for x in want.values()) > sum(x[1] for x in forward.values())


@pytest.mark.parametrize("end", ["\n" + "short line of ten words " * 2, "\n", "\n\n \n", "\na\n\nb"])
def test_lines_copy_loses_every_line(spark, end):
    text = " ".join(f"w{k}" for k in range(60)) + end
    docs = edge.frame(spark, [(1, text, "s"), (2, text, "s"), (3, "new\n" + text + "\nown", "s")])
    got = {r["doc_id"]: r for r in lines.dedup_lines(docs, whole_runs=True).collect()}
    assert got[1]["text"] == text and got[1]["removed"] == []
    n = text.count("\n") + 1
    assert got[2]["text"] == "" and [tuple(x) for x in got[2]["removed"]] == [(0, n)]
    assert got[3]["text"] == "new\nown"
    import corpus_pipeline
    assert {r["doc_id"] for r in corpus_pipeline.stage_lines(spark, docs, "").collect()} == {1, 3}


# --- op7 ------------------------------------------------------------------------

def test_secrets_edge(spark, edge_dir):
    got = QUERIES["op7_secrets"](spark, edge_dir).collect()
    want = {}
    for d, t, _ in edge.documents():
        want.setdefault(d, []).append(edge.base_spans(t))
    assert len(got) == len(edge.documents())
    assert any(want[21][0])
    for r in got:
        spans = [s for s in r["spans"].split(",") if s]
        base = [tuple(s.split(":")) for s in spans if not s.startswith("crf")]
        base = [(k, int(a), int(b)) for k, a, b in base]
        assert base in want[r["doc_id"]]
        assert r["base_sha256"] == edge.sha(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode())
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))


def test_viterbi_is_exact():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    for turn in range(120):
        chain = secret_field.Chain()
        chain.weights = rng.normal(0, 0.7, chain.weights.shape)
        chain.weights[:, 0] += 0.5 * (turn % 3)
        chain.step, chain.open, chain.close = rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3), rng.normal(0, 1, 3)
        text = b" ".join([b"ab", b"x=1", b"0f3a"][i] for i in rng.integers(0, 3, 4)) + b"\nq 12\n\nz"
        tokens_ = secret_field.Tokens([text], [(0, 0, 0)])
        tag, score = chain.decode(tokens_), chain.emissions(tokens_.index)
        first = np.flatnonzero(tokens_.first)
        for a, b in zip(first, np.r_[first[1:], len(tag)], strict=True):
            def total(p):
                return (chain.open[p[0]] + sum(score[a + i, p[i]] for i in range(b - a)) + chain.close[p[-1]]
                        + sum(chain.step[p[i], p[i + 1]] for i in range(b - a - 1)))
            assert tuple(tag[a:b]) == max(itertools.product(range(3), repeat=b - a), key=total)


def test_field_finds_secrets_that_patterns_miss():
    rng = random.Random(3)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(16, 40))) for _ in range(80)]
    train = [(f"the {w} of token = \"{h}\" here".encode(), [(len(f"the {w} of token = \"".encode()),
              len(f"the {w} of token = \"{h}".encode()))], (0, 0, 2)) for w, h in zip(edge.WORDS * 7, hexes)]
    train += [(edge.words(rng, 12).encode(), [], (0, 0, 2)) for _ in range(80)]
    chain = secret_field.train(train)
    text = b'the beta of token = "0123456789abcde" here'  # one short of the hex pattern, quoted
    quoted = b'the beta of tokens = "9f3c01ab77d2e4b" here'
    assert secret_field.base_spans(quoted) == []
    assert secret_field.find_spans([text, quoted], chain)[1] == [(22, 3, 37)]
    assert secret_field.find_spans([b"the beta of words12 here"], chain) == [[]]


def test_secrets_learn_from_all_documents(spark, monkeypatch):
    """Rare secrets, deep in a text or in a long line, and other lines from anywhere in a text."""
    monkeypatch.setattr(secret_field, "train", lambda found: found)
    plain = "\n".join(f"plain line {k}" for k in range(12))
    docs = spark.range(4_100).select(F.col("id").alias("doc_id"), F.lit(plain).alias("text"))
    last = docs.orderBy(F.xxhash64(F.lit(9), "doc_id").desc()).limit(1).first()[0]
    long = "x " * 50_000 + "token = abcdefghijkl0123"
    docs = docs.withColumn("text", F.when(F.col("doc_id") == last, F.concat("text", F.lit(
        "\npassword: hunter2hunter2\n" + long))).otherwise(F.col("text")))
    found = secret_field.fit(docs)
    assert sorted(line[a:b] for line, spans, _ in found for a, b in spans) == [b"abcdefghijkl0123", b"hunter2hunter2"]
    assert {line for line, spans, _ in found if not spans} == set(plain.encode().split(b"\n"))
    assert max(len(line) for line, _, _ in found) <= secret_field.LONGEST
    assert len(secret_field.fit(docs, max_lines=6)) == 5  # two with a match, three others


# --- op8 ------------------------------------------------------------------------

def library(vocabulary, unknown, byte_fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers
    t = Tokenizer(models.Unigram(vocabulary, unk_id=unknown, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokens.SPACE_MARK, prepend_scheme="always", split=True)
    return t


def test_tokens_edge(spark, edge_dir):
    vocabulary, unknown = tokens.load_vocabulary()
    want = library(vocabulary, unknown, True)
    expect = sorted(((d, len(t or ""), len(want.encode(t or "", add_special_tokens=False).ids))
                     for d, t, _ in edge.documents()), key=str)
    assert rows(QUERIES["op8_tokens"](spark, edge_dir)) == expect


def test_token_ties():
    rng = random.Random(1)
    for _ in range(150):
        vocabulary = {"<unk>": 0.0}
        for _ in range(rng.randint(2, 12)):
            vocabulary["".join(rng.choice("abc▁") for _ in range(rng.randint(1, 4)))] = rng.choice([-1.0, -2.0, -3.0, -1.5])
        pairs = list(vocabulary.items())
        want, counter = library(pairs, 0, False), tokens.UnigramCounter(pairs, byte_fallback=False)
        for _ in range(20):
            s = "".join(rng.choice("abcd x") for _ in range(rng.randint(0, 14)))
            assert counter.text(s) == len(want.encode(s, add_special_tokens=False).ids), (pairs, s)
            for w in s.split(" "):
                assert counter._viterbi_long(w) == counter._viterbi(w), (pairs, w)


def test_token_of_a_very_long_word():
    """Memory follows the longest piece, not the word; the count is the short form's."""
    import tracemalloc
    vocabulary, _ = tokens.load_vocabulary()
    counter = tokens.UnigramCounter(vocabulary)
    rng = random.Random(8)
    some = ["the", "tion", "日本", "é", "🎉", "0", "zzz", "\u0378"]
    word = "".join(rng.choice(some) for _ in range(60_000))
    assert counter._viterbi_long(word[:9_000]) == counter._viterbi(word[:9_000])
    tracemalloc.start()
    counter.text(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(word) and not counter.known


# --- op9 ------------------------------------------------------------------------

def test_digest_edge(spark, edge_dir):
    order = sorted(((d, t or "") for d, t, _ in edge.documents()),
                   key=lambda r: (r[0] is None, -(r[0] or 0), edge.text_hash(r[1])))
    want = []
    for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        third = len(t) // 3
        edited = t[:len(t) - third] + after[:third]
        own, new, following = (edge.digest(x.encode()) for x in (t, edited, after))
        want.append((d, len(t), edge.sha(edited.encode()), own, new, edge.digest_likeness(own, new),
                     edge.digest_likeness(own, following)))
    got = rows(QUERIES["op9_digest"](spark, edge_dir))
    assert got == sorted(want, key=str)
    assert all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in got)


def test_digest_of_pieces(monkeypatch):
    rng = random.Random(2)
    parts = [edge.words(rng, n).encode() for n in (0, 1, 30, 400, 3)]
    whole = digest.codes(parts)
    monkeypatch.setattr(digest, "_CHUNK", 100)
    assert (digest.codes(parts) == whole).all()
    assert (digest.from_hex(digest.to_hex(whole)) == whole).all()


def test_digest_separates(spark):
    got = digest.successors(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    closer = got.agg(F.avg((F.col("near_edited") > F.col("near_next")).cast("int"))).first()[0]
    assert closer > 0.97


def test_compare_column(spark):
    docs = edge.frame(spark, edge.documents()).withColumn("a", digest.fingerprint())
    assert docs.select(digest.compare(F.col("a"), F.col("a")).alias("x")).where("x <> 1").count() == 0


# --- op10 -----------------------------------------------------------------------

def test_quality_edge(spark, edge_dir):
    got = QUERIES["op10_quality"](spark, edge_dir).collect()
    assert len(got) == len(edge.documents())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    by_text = {}
    for r in got:
        if r["doc_id"] in (4, 5, 13, 14):
            by_text.setdefault(r["doc_id"] // 10, set()).add(r["score"])
    assert all(len(x) == 1 for x in by_text.values())


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op10_quality"](spark, sf).join(labels, "doc_id").where("held_out and quality is not null")
    right = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95


def test_quality_ignores_held_out_labels(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{edge_dir}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, flipped)
    assert (a.weights == b.weights).all() and (a.slope, a.offset) == (b.slope, b.offset)


def test_quality_without_labels(spark):
    docs = edge.frame(spark, edge.documents())
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(docs, none)
    assert {round(r[0], 6) for r in docs.select(quality.score(model)).collect()} == {0.5}


def test_nonnegative_risk_learns_from_positives_and_unlabelled():
    import numpy as np
    rng = np.random.default_rng(0)
    positive = rng.normal(1.5, 1, (400, 4))
    unlabelled = np.concatenate([rng.normal(1.5, 1, (600, 4)), rng.normal(-1.5, 1, (200, 4))])
    model = quality.fit_nnpu(positive, unlabelled, 0.75)
    test = np.concatenate([rng.normal(1.5, 1, (500, 4)), rng.normal(-1.5, 1, (500, 4))])
    right = ((model.margin(test) > 0) == (np.arange(1000) < 500)).mean()
    assert right > 0.97


def test_quality_takes_one_row_of_an_id(spark):
    """A chosen id that fills a large share of the rows counts once."""
    docs = spark.createDataFrame([(k, edge.words(random.Random(k), 20 + k % 30)) for k in range(200)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    hot = next(k for k in range(1, 60, 2) if not docs.where(f"doc_id = {k}").where(quality.held_out()).count())
    often = docs.unionByName(docs.where(f"doc_id = {hot}").crossJoin(spark.range(400)).select("doc_id", "text"))
    a, b = quality.fit(docs, labels), quality.fit(often, labels)
    assert a.weights.any()
    assert (a.mean == b.mean).all() and (a.weights == b.weights).all() and (a.slope, a.offset) == (b.slope, b.offset)
