"""Registered queries of this subpackage, one per operator, over whole tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` has DuckDB
SQL for those that SQL can express on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversations, decontaminate, digest, licenses, lines, mixing, periodic, quality, rules, secret_field,
               simhash, suffixes, tokens)
from .common import sha256_hex, table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"),
                        F.size(F.filter("sentence_ids", lambda x: x == "?")).cast("long").alias("n_unknown"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of the production weights."""
    plan = mixing.schedule(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "mix_source", "block", "release", "deadline", "slot", "offset", "in_mix")


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat 100 bytes from earlier."""
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        sha256_hex(F.col("kept")).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 3 bits."""
    found = simhash.classes(table(spark, sf_dir, "documents"), shingle=3, seed=42, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document: windows of 10 words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), n=10)
    n_hit = decontaminate.n_hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        sha256_hex(F.concat_ws(",", F.array_sort("items"))).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated runs of lines of at least 50 words, deleted from every document but the first."""
    found = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50, whole_runs=True)
    return found.select("doc_id", "n_lines", lines.n_removed().alias("n_removed"),
                        F.size("removed").cast("long").alias("n_runs"),
                        sha256_hex(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base patterns and what the trained field adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_field.scan(docs, secret_field.fit(docs))

    def joined(only_base: bool):
        spans = F.filter("spans", lambda s: s["kind"] != "crf") if only_base else F.col("spans")
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, sha256_hex(joined(True)).alias("base_sha256"),
                        joined(False).alias("spans"))


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count of every document."""
    vocabulary, _ = tokens.load_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tokens.count_tokens(docs, tokens.UnigramCounter(vocabulary))
    return found.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
                        "n_tokens")


def op9_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document, its edited text and its successor."""
    return digest.successors(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return (docs.withColumn("score", quality.score(model))
            .select("doc_id", quality.held_out().alias("held_out"), "score",
                    (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")))


def _damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with the damage that their contract states, nulls as one space; ``here`` is false for a dropped row."""
    def told(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", told("conv_id"), told("turn"))) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(told("text"), "[.!?]", ""))
            .otherwise(told("text")))
    role = F.when(kind == 4, F.lit("user")).otherwise(told("role"))
    copies = F.array_repeat(kind != 0, F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("here"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after the damage of the contract."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversations.repair(_damaged(rows), F.col("here"))
    hashes = conversations.digests(repaired.turns).withColumnRenamed("conv_id", "_id")
    return repaired.report.join(hashes, F.col("conv_id").eqNullSafe(F.col("_id"))).drop("_id")


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of every document, and the verdict of the current policy."""
    found = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        (~rules.passes("base")).alias("base_failed"), rules.passes("v1").alias("kept"), "failed")


def _looped(doc_id: str = "doc_id", text: str = "text"):
    """The text with the planted period of the contract; a null id has no hash and keeps its text."""
    return F.expr(f"""
    CASE WHEN crc32(CAST({doc_id} AS STRING)) % 10 = 0 THEN array_join(transform(
      transform(array(named_struct('w', filter(split({text}, '[ \\\\t-\\\\r]+'), w -> w <> ''),
                                   'g', crc32(CAST({doc_id} AS STRING)) DIV 10)),
                x -> named_struct('w', x.w, 'n', CAST(size(x.w) AS BIGINT), 'g', x.g,
                                  'a', IF(size(x.w) > 0, CAST(x.g % size(x.w) AS INT), 0))),
      x -> array_join(transform(x.w, (w, i) -> IF(i < x.a, w,
             x.w[x.a + (i - x.a) % CAST(1 + (x.n - x.a) DIV (3 + x.g % 8) AS INT)])), ' ')), ' ')
    ELSE {text} END""")


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, after the loops that the contract plants."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text", _looped())
    best = periodic.strongest()
    found = periodic.find_runs(docs).select("doc_id", "runs", "collapsed", best.alias("best"))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(
        r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        sha256_hex(told).alias("runs_sha256"), sha256_hex(F.col("collapsed")).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_licenses, op2_mixing, op3_suffixes, op4_simhash, op5_decontaminate, op6_lines, op7_secrets, op8_tokens,
                                   op9_digest, op10_quality, op11_conversations, op12_rules, op13_periodic)}

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    """The sentence and rule tables are fixed values; cutting, naming and matching are written in SQL."""
    name = []
    for label, pattern in licenses.SENTENCES:
        whole = _quoted(f"^(?:{pattern})$")
        value = f"{_quoted(label)} || regexp_extract(s, {whole}, 1)" if label.endswith(":") else _quoted(label)
        name.append(f"when regexp_matches(s, {whole}) then {value}")
    keywords = _quoted(licenses.KEYWORDS)
    breaks = " || ".join(f"chr({ord(c)})" for c in licenses.BREAKS)
    rounds, before = [], "seq"
    for k, (licence, pattern) in enumerate(licenses.RULES):
        p = _quoted(pattern)
        rounds.append(f"""r{k} as (select doc_id, regexp_replace(rest, {p}, '|', 'g') as rest,
  case when regexp_matches(rest, {p}) and not list_contains(found, {_quoted(licence)})
       then list_append(found, {_quoted(licence)}) else found end as found from {before})""")
        before = f"r{k}"
    return f"""
with t as (select doc_id, translate(coalesce(text, ''), {breaks}, '      ') as x from documents),
parts as (
  select doc_id, string_split(regexp_replace(regexp_replace(x, {_quoted(licenses.JOIN_LINE)}, '\\1 \\2', 'g'),
                              {_quoted(licenses.END_SENTENCE)}, '\\1' || chr(10), 'g'), chr(10)) as p from t),
told as (
  select doc_id, list_transform(list_filter(p, lambda x: regexp_matches(lower(x), {keywords})), lambda x:
    replace(trim(regexp_replace(regexp_replace(lower(x), {_quoted(licenses.MARKS)}, '', 'g'),
            '[ \\t]+', ' ', 'g'), ' '), 'licence', 'license')) as ss from parts),
ids as (
  select doc_id, i, case {' '.join(name)} else '?' end as id
  from (select doc_id, generate_subscripts(ss, 1) as i, unnest(ss) as s from told)),
agg as (select doc_id, list(id order by i) as l from ids group by doc_id),
seq as (select doc_id, array_to_string(list_transform(l, lambda x: '<' || x || '>'), '') as rest,
               cast([] as varchar[]) as found from agg),
{','.join(rounds)}
select t.doc_id, coalesce(array_to_string(agg.l, ','), '') as sentence_ids,
       coalesce(array_to_string({before}.found, ','), '') as licenses,
       cast(coalesce(len(list_filter(agg.l, lambda x: x = '?')), 0) as bigint) as n_unknown
from t left join agg using (doc_id) left join {before} using (doc_id)
"""


SQL: dict[str, str] = {
    "op1_licenses": _license_sql(),
    "op2_mixing": """
with recursive w(k, s, a) as (
  select unnest(range(1, 22)), unnest(list_concat(['src0'], list_concat(
           list_transform(range(1, 20), lambda x: 'src' || x), ['*']))),
         unnest(list_concat([20], list_concat(list_concat(
           list_transform(range(1, 10), lambda x: 5), list_transform(range(10, 20), lambda x: 3)), [5])))),
l as (select list(a order by k) as a, list(s order by k) as s from w),
-- one period: the earliest deadline among the blocks that are released
sim(t, n, p, j) as (
  select -1, list_transform(range(0, 21), lambda x: 0), 0, 0
  union all
  select t + 1, list_transform(n, lambda x, i: x + case when i = q then 1 else 0 end), q, n[q]
  from (select sim.t, sim.n, list_sort(list_transform(
          list_filter(range(1, 22), lambda i: sim.n[i] < l.a[i] and (sim.n[i] * 100) // l.a[i] <= sim.t + 1),
          lambda i: {'d': ((sim.n[i] + 1) * 100 + l.a[i] - 1) // l.a[i], 'i': i}))[1].i as q
        from sim, l where sim.t < 99)),
period as (select w.s, w.a, sim.j, sim.t from sim join w on w.k = sim.p where sim.t >= 0),
d as (
  select doc_id, text, length(coalesce(text, '')) as n,
         cast('0x' || md5(coalesce(cast(doc_id as varchar), '') || chr(10) || coalesce(text, ''))[1:15] as bigint) as o,
         case when source in (select s from w where s <> '*') then source else '*' end as s
  from documents),
c as (
  select *, cast(coalesce(sum(n) over (partition by s order by o, doc_id
                 rows between unbounded preceding and 1 preceding), 0) as bigint) as before from d),
b as (select c.*, before // 65536 as block from c),
size as (select w.s, w.a, coalesce(sum(n), 0) as total from w left join d on d.s = w.s group by w.s, w.a),
gap as (
  select min(m // size.a * 100 + period.t) as g
  from (select *, cast((total + 65535) // 65536 as bigint) as m from size) size
  join period on period.s = size.s and period.j = m % size.a)
select b.doc_id, b.s as mix_source, b.block, b.block * 100 // p.a as release,
       ((b.block + 1) * 100 + p.a - 1) // p.a as deadline, b.block // p.a * 100 + p.t as slot,
       b.before as "offset", b.block // p.a * 100 + p.t < gap.g as in_mix
from b join period p on p.s = b.s and p.j = b.block % p.a cross join gap
""",
    "op5_decontaminate": r"""
with d as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
b as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null),
bw as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as g
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hits as (select dw.doc_id, dw.i, dw.n, bw.item_id from dw join bw on dw.n = bw.n and dw.g = bw.g),
hw as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hits)) group by doc_id),
hi as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from hits) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(hw.n_hit, 0) as bigint) as n_hit,
       cast(coalesce(hi.n_items, 0) as bigint) as n_items, sha256(coalesce(hi.ids, '')) as items_sha256,
       coalesce(hw.n_hit, 0) > 0 as contaminated
from d left join hw using (doc_id) left join hi using (doc_id)
""",
    "op12_rules": r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from t),
g as (select doc_id, i, array_to_string(w[i:i + 4], ' ') as g
      from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w where len(w) >= 5)),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as c from g) where c > 1),
r as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + 5)) as p from twice) group by doc_id),
m as (
  select w.doc_id, cast(len(w) as bigint) as n_words,
         cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) as bigint) as letters,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(ls) as bigint) as n_lines, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
         cast(coalesce(r.n, 0) as bigint) as n_repeat_words
  from w left join r using (doc_id)),
f as (select *, case when n_words < 10 then 1 else 0 end + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
           + case when 10 * n_symbols > n_words then 4 else 0 end + case when 2 * n_dup_lines > n_lines then 8 else 0 end
           + case when word_chars < 2 * n_words then 16 else 0 end + case when word_chars > 15 * n_words then 32 else 0 end
           + case when 2 * letters < word_chars then 64 else 0 end as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits & 3 <> 0 as base_failed, bits = 0 as kept,
       cast(bits as bigint) as failed from f
""",
    "op6_lines": r"""
with t as (select doc_id, coalesce(text, '') as text from documents),
raw as (select doc_id, string_split(text, chr(10)) as ls from t),
l as (
  select doc_id, i, ls[i] as raw_line, regexp_replace(ls[i], '^[ \t\n\v\f\r]+|[ \t\n\v\f\r]+$', '', 'g') as line
  from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i from raw)),
w as (
  select *, case when line = '' then 0 else len(string_split_regex(line, '[ \t\v\f\r]+')) end as n from l),
c as (
  select *, sum(n) over (partition by doc_id order by i rows unbounded preceding) as upto from w),
-- the shortest runs of 50 words from each line on, and those up to each line: together they cover
-- every line of every repeated run of 50 words
e as (
  select a.doc_id, a.i, min(b.i) as j
  from c a join c b on a.doc_id = b.doc_id and b.i >= a.i and b.upto >= a.upto - a.n + 50
  group by a.doc_id, a.i
  union
  select b.doc_id, max(a.i), b.i
  from c a join c b on a.doc_id = b.doc_id and b.i >= a.i and b.upto >= a.upto - a.n + 50
  group by b.doc_id, b.i),
k as (
  select e.doc_id, e.i, e.j, string_agg(c.line, chr(10) order by c.i) as key
  from e join c on c.doc_id = e.doc_id and c.i between e.i and e.j group by e.doc_id, e.i, e.j),
late as (
  select doc_id, i, j from (select *, row_number() over (partition by key order by doc_id, i) as r from k) where r > 1),
gone as (select distinct c.doc_id, c.i from late join c on c.doc_id = late.doc_id and c.i between late.i and late.j),
m as (
  select c.doc_id, c.i, c.raw_line, gone.i is not null as g,
         coalesce(lag(gone.i is not null) over (partition by c.doc_id order by c.i), false) as p
  from c left join gone on c.doc_id = gone.doc_id and c.i = gone.i)
select doc_id, count(*) as n_lines, cast(count(case when g then 1 end) as bigint) as n_removed,
       cast(count(case when g and not p then 1 end) as bigint) as n_runs,
       sha256(coalesce(string_agg(raw_line, chr(10) order by i) filter (where not g), '')) as kept_sha256
from m group by doc_id
""",
}
