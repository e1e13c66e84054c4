"""op12: measurements, bits, policies and ablation."""

import random

import edge
from edge import edge_dir, empty_dir  # noqa: F401  (fixtures)

from urbanpulse.llm import rules, words
from urbanpulse.llm.queries import QUERIES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edge(spark, edge_dir):
    got = QUERIES["op12_rules"](spark, edge_dir)
    assert rows(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
                ) == edge.rule_rows(edge.documents())
    assert got.where("kept and base_failed").count() == 0
    assert got.where("kept <> (failed = 0)").count() == 0


def test_random_texts_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(words, "CHUNK_BYTES", 40)
    rng = random.Random(1)
    docs = [(k, "".join(rng.choice(["a", "b", "ab", "é", " ", " ", "\n", "#", "\t", "x\n", "a b c d e "])
                        for _ in range(rng.randint(0, 60))), "s") for k in range(200)]
    found = rules.ledger(edge.frame(spark, docs))
    assert found.columns == [*(c for c in edge.frame(spark, docs).columns if c != "n_words" and c != "n_lines"),
                             *rules.MEASURES, "failed"]
    got = found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", ~rules.passes("base"))
    assert rows(got) == edge.rule_rows(docs)


def test_windows_with_colliding_hashes(monkeypatch):
    """The words decide, not their hashes."""
    import numpy as np
    rng = random.Random(3)
    ids = np.array([rng.randint(0, 3) for _ in range(400)])
    starts = np.array([0, 0, 100, 103, 400])

    def want(size):
        out = []
        for a, b in zip(starts, starts[1:], strict=False):
            seen: dict = {}
            for i in range(a, b - size + 1):
                seen.setdefault(tuple(ids[i:i + size]), []).append(i)
            out += [i for at in seen.values() if len(at) > 1 for i in at]
        return sorted(out)

    for size in (1, 2, 5, 9):
        assert words.repeated_windows(ids, starts, size).tolist() == want(size)

    class Flat:
        def integers(self, low, high, size, dtype):
            return np.zeros(size, dtype=dtype)

    monkeypatch.setattr(np.random, "default_rng", lambda seed: Flat())  # all factors 1: sums collide
    for size in (2, 5):
        assert words.repeated_windows(ids, starts, size).tolist() == want(size)


def test_each_rule_fails_on_its_own(spark):
    plain = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    cases = {
        "few_words": " ".join(plain[:9]),
        "repeated_windows": " ".join(plain[:30] + plain[:5] + ["x1"] + plain[:5]),
        "symbols": " ".join(plain) + " #####",
        "duplicate_lines": "\n".join(plain[:12] + plain[9::-1] + plain[:9:2]),
        "short_words": " ".join("abcdefghijklmnopqrstuvw"),
        "long_words": " ".join(w * 4 for w in plain),
        "few_letters": " ".join(f"12345{k}" for k in range(40)),
    }
    docs = spark.createDataFrame([(k, t) for k, t in cases.items()] + [("none", " ".join(plain))], "doc_id string, text string")
    got = {r["doc_id"]: r["failed"] for r in rules.ledger(docs).collect()}
    assert got.pop("none") == 0
    assert got == {k: rules.mask(k) for k in cases}


def test_ablation(spark, edge_dir):
    entries = QUERIES["op12_rules"](spark, edge_dir)
    bits = [r["failed"] for r in entries.collect()]
    got = {(r["policy"], r["rule"]): r for r in rules.ablate(entries).collect()}
    assert len(got) == 2 + len(rules.RULES)
    for (policy, rule), r in got.items():
        mask, own = rules.POLICIES[policy], rules.mask(rule)
        assert r["docs"] == len(bits) and r["kept"] == sum(b & mask == 0 for b in bits)
        assert r["failing"] == sum(b & own > 0 for b in bits)
        assert r["only_rule"] == sum(b & mask == own for b in bits)
        assert r["only_rule"] + r["with_others"] == r["failing"]
        without = {k: m & ~own for k, m in rules.POLICIES.items()}
        assert r["kept"] + r["only_rule"] == sum(b & without[policy] == 0 for b in bits)
    assert rules.ablate(entries.limit(0)).where("docs + kept + failing > 0").count() == 0


def test_clean_documents_stay(spark):
    """No document that the labels call good is rejected by the rules beyond the base."""
    sf = "/root/testdata/sf0.1"
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").select("doc_id").distinct()
    found = QUERIES["op12_rules"](spark, sf).join(good, "doc_id")
    assert found.where("not kept and not base_failed").count() == 0
    assert found.where("kept").count() > 0.9 * found.count()
