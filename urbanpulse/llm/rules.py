"""Quality rules as a ledger of failure bits.

``ledger`` evaluates every rule once per document: it stores the measurements and one
bit per failed rule (``failed``).  A policy is a versioned mask of rules; a document is
kept under a policy when none of the policy's bits is set, so that another policy, or
the same one less a rule, needs no second look at the text.

``ablate`` reports what each rule does in each policy.  The ledger is first counted by
its distinct bit patterns (a partial aggregate, at most 2 to the number of rules rows);
everything else is arithmetic on the bits of those rows.

Measurements: words are ``[^\\x20\\x09-\\x0D]+``.  ``word_chars`` code points in words,
``letters`` those of them that are A-Z, a-z or beyond ASCII, ``n_symbols`` characters of
``[#*$%&|<>]``, ``n_lines`` lines (cut at ``\\n``) with a word, ``n_dup_lines`` those equal
to an earlier line, ``n_repeat_words`` words in 5-word windows that the text has twice or
more, the first of them included.

Null and empty texts have no words and fail ``few_words``.  Whole texts are measured;
the memory of a task follows its longest text.  Rows are taken one by one: repeated
rows and ties of an id get the same ledger.  An empty table gives an empty ledger.
Extra columns stay; columns with the names of results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import seal, utf8
from .words import WHITE, chunks, number_words, repeated_windows

WINDOW = 5
MEASURES = ("n_words", "word_chars", "letters", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


class Rule(NamedTuple):
    """A rule fails where ``left * lhs > right * rhs`` (measurements, or a number for ``lhs`` or ``rhs``)."""

    name: str
    left: int
    lhs: str | int
    right: int
    rhs: str | int


#: Bit k of ``failed`` belongs to rule k.  Rules are only added at the end.
RULES = (
    Rule("few_words", 1, 10, 1, "n_words"),
    Rule("repeated_windows", 100, "n_repeat_words", 20, "n_words"),
    Rule("symbols", 10, "n_symbols", 1, "n_words"),
    Rule("duplicate_lines", 2, "n_dup_lines", 1, "n_lines"),
    Rule("short_words", 2, "n_words", 1, "word_chars"),
    Rule("long_words", 1, "word_chars", 15, "n_words"),
    Rule("few_letters", 1, "word_chars", 2, "letters"),
)


def mask(*names: str) -> int:
    """The bits of some rules."""
    known = [r.name for r in RULES]
    return sum(1 << known.index(n) for n in names)


#: Version -> mask.  A version never changes; a new set of rules is a new version.
POLICIES: dict[str, int] = {
    "base": mask("few_words", "repeated_windows"),
    "v1": mask(*(r.name for r in RULES)),
}

_SYMBOLS = b"#*$%&|<>"
_NOT_STARTS = bytes(range(0x80, 0xC0))  # bytes that go on with a code point
_NOT_LETTERS = bytes(b for b in range(0x80) if not chr(b).isalpha()) + _NOT_STARTS


def measure(found: list[bytes]) -> np.ndarray:
    """A row of ``MEASURES`` for each text of a chunk."""
    split = [t.split() for t in found]
    ids, starts = number_words(split)
    out = np.zeros((len(found), len(MEASURES)), dtype=np.int64)
    out[:, 0] = np.diff(starts)
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    at = repeated_windows(ids, starts, WINDOW)
    covered[at] += 1
    np.add.at(covered, at + WINDOW, -1)
    upto = np.r_[0, np.cumsum(np.cumsum(covered[:-1]) > 0)]
    out[:, 6] = upto[starts[1:]] - upto[starts[:-1]]
    for k, text in enumerate(found):
        seen, lines, twins = set(), 0, 0
        for line in text.split(b"\n"):
            if line.strip():
                lines += 1
                if line in seen:
                    twins += 1
                else:
                    seen.add(line)
        out[k, 1:6] = (len(text.translate(None, WHITE + _NOT_STARTS)), len(text.translate(None, _NOT_LETTERS)),
                       len(text) - len(text.translate(None, _SYMBOLS)), lines, twins)
    return out


def _side(factor: int, what: str | int) -> Column:
    return F.lit(factor) * (F.col(what) if isinstance(what, str) else F.lit(what))


def failure_bits() -> Column:
    """The bits of the rules that the measurements of a row fail."""
    bits = F.lit(0).cast("long")
    for k, r in enumerate(RULES):
        fails = _side(r.left, r.lhs) > _side(r.right, r.rhs)
        bits = bits.bitwiseOR(F.when(fails, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed``, the bits of the failed rules."""
    docs, (text_col,), unseal = seal(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            rows = [measure(found) for found in chunks(column)]
            table = np.concatenate(rows) if rows else np.zeros((0, len(MEASURES)), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c.copy()) for c in table.T)],
                                             names=[*batch.schema.names, *MEASURES])

    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(m, T.LongType()) for m in MEASURES)])
    return unseal(docs.mapInArrow(run, schema).withColumn("failed", failure_bits()), *MEASURES, "failed")


def passes(policy: str | int, failed: str = "failed") -> Column:
    """True where no rule of the policy (a version, or a mask) fails."""
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(failed).bitwiseAND(F.lit(bits).cast("long")) == 0


def ablate(entries: DataFrame, policies: Mapping[str, int] = POLICIES, failed: str = "failed") -> DataFrame:
    """One row per policy and rule in it, from the stored bits alone.

    ``docs`` all documents, ``kept`` those that the policy keeps, ``failing`` those that fail
    the rule, ``only_rule`` those that nothing else in the policy rejects (what it would keep
    more without the rule), ``with_others`` the rest of the failing.
    """
    spark = entries.sparkSession
    patterns = entries.groupBy(F.col(failed).alias("bits")).agg(F.count(F.lit(1)).alias("times"))
    asked = [(v, m, k, r.name, 1 << k) for v, m in policies.items() for k, r in enumerate(RULES) if m >> k & 1]
    each = F.explode(F.array(*(F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(k).alias("bit"),
                                        F.lit(own).cast("long").alias("own")) for v, m, k, _, own in asked)))
    told = patterns.select("bits", "times", each.alias("p")).select("bits", "times", "p.*")
    inside = F.col("bits").bitwiseAND(F.col("mask"))
    has = inside.bitwiseAND(F.col("own")) != 0

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("times")).otherwise(F.lit(0))).alias(name)

    counts = told.groupBy("policy", "bit").agg(
        F.sum("times").alias("docs"), total(inside == 0, "kept"), total(has, "failing"),
        total(inside == F.col("own"), "only_rule"), total(has & (inside != F.col("own")), "with_others"))
    plan = spark.createDataFrame([(v, k, name) for v, _, k, name, _ in asked], "policy string, bit int, rule string")
    return plan.join(counts, ["policy", "bit"], "left").na.fill(0).select("policy", "bit", "rule", *counts.columns[2:]).orderBy(
        "policy", "bit")
