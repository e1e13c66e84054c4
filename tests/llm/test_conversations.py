"""op11: repaired conversations against a recursion over costs and strings."""

import itertools
import random

import edge
import pytest
from edge import edge_dir, empty_dir  # noqa: F401  (fixtures)

from urbanpulse.llm import conversations as C
from urbanpulse.llm.queries import QUERIES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [1, 3, 256])
def test_edge(spark, edge_dir, monkeypatch, block):
    """The same result wherever the conversations are cut."""
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    got = rows(QUERIES["op11_conversations"](spark, edge_dir))
    assert got == edge.conversation_rows(edge.conversations())
    assert any(r[0] == 99 and len(r[7]) > 600 for r in got) and any(r[0] is None for r in got)


def test_given_table(spark):
    sf = "/root/testdata/sf0.01"
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(QUERIES["op11_conversations"](spark, sf)) == edge.conversation_rows(given)


def test_all_damaged_away(spark, scratch_dir):
    """A conversation whose rows are all dropped stays, with zeros."""
    import zlib
    gone = [c for c in range(300) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    spark.createDataFrame([(c, 0, "user", "x.") for c in gone], "conv_id long, turn long, role string, text string"
                          ).write.parquet(f"{scratch_dir}/conversations.parquet")
    got = rows(QUERIES["op11_conversations"](spark, scratch_dir))
    assert got == sorted(((c, 0, 0, 0, 0, 0, 0, "", edge.sha(b"")) for c in gone), key=str)


def test_repaired_turns(spark):
    given = [(1, 0, "user", "Hi."), (1, 1, "user", "There?"), (1, 2, "assistant", "Yes"), (2, None, None, "  ")]
    found = C.repair(spark.createDataFrame(given, "conv_id int, turn int, role string, text string"))
    assert rows(found.report) == [(1, 0, 0, 0, 1, 1, 3, "KIKK"), (2, 0, 1, 0, 0, 0, 3, "D")]
    turns = found.turns.orderBy("conv_id", "seg").select("conv_id", "turns").collect()
    assert [(r[0], *t) for r in turns for t in r[1]] == [
        (1, "user", "Hi."), (1, "assistant", ""), (1, "user", "There?"), (1, "assistant", "Yes")]


def test_integers_order_as_cost_and_audit():
    rng = random.Random(0)
    width = 9

    def weight(cost, audit):
        w = 0
        for x in reversed(audit):
            w = C.before(w, 0, C.LETTERS.index(x), width)
        return w + (cost << C.BITS * width)

    some = [(rng.randint(0, 3), "".join(rng.choice("DIKR") for _ in range(rng.randint(0, width)))) for _ in range(300)]
    assert sorted(some) == sorted(some, key=lambda x: weight(*x))
    for cost, audit in some:
        w = weight(cost, audit)
        assert (w >> C.BITS * width, C.audit_text(w, width), C.length(w, width)) == (cost, audit, len(audit))
    for (a, x), (b, y) in itertools.pairwise(some):
        both = C.concatenate(weight(a, x), width, weight(b, y), width)
        assert (both >> C.BITS * 2 * width, C.audit_text(both, 2 * width)) == (a + b, x + y)


def test_random_against_recursion():
    """Every block size gives the recursion's cost and audit; repeated rows count as often as they occur."""
    rng = random.Random(5)
    for _ in range(150):
        given = [(1, t, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b.", "c", "", "d?"]))
                 for t in range(rng.randint(0, 7)) for _ in range(rng.choice([1, 1, 1, 3]))]
        want = edge.repaired(given)
        counted: dict = {}
        for r in sorted(given, key=lambda r: (r[1], r[2], r[3])):
            counted[r] = counted.get(r, 0) + 1
        seen, typed = set(), []
        for (_, _, role, text), n in counted.items():
            typed.append((C.Row(role, "blank" if not text else "duplicate" if (role, text) in seen
                                else "truncated" if text == "c" else "", n), text))
            seen.add((role, text))
        for size in (1, 2, 50):
            blocks, cuts = [], [typed[k:k + size] for k in range(0, len(typed), size)]
            for seg, block in enumerate(cuts):
                own = [r for r, _ in block]
                width, weights = C.block_width(own), [""] * 16
                for end in range(4):
                    for start, w in enumerate(C.solve(own, end, width)):
                        weights[4 * start + end] = "" if w is None else f"{w:x}"
                blocks.append({"seg": seg, "width": width, "weights": weights})
            cost, audit, pieces = C.join_blocks(blocks)
            turns = [t for (_, state, letters), block in zip(pieces, cuts, strict=True) for t in C.replay(letters, block, state)]
            text = "\n".join(f"{r}:{t}" for r, t in turns)
            assert (cost, audit, edge.sha(text.encode())) == want[5:]
