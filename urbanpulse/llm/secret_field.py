"""Secret scans by a linear-chain conditional random field.

Base patterns (assignments, access keys, hex runs) are matched in every whole
text.  A conditional random field then tags the tokens of every line as secret
begin, inside or outside and adds the spans that the patterns miss; base spans
stay.

Tokens are runs of letters, digits, ``_`` and non-ASCII bytes; every other byte
but white space is a token of its own.  A line is one sequence.  Features: the
token's shape (character classes, length, changes between letters and digits),
the shapes and hashed words of its neighbours, white space around it, and file
features (digit share, punctuation share, line length of the document).

Training: maximum likelihood (forward-backward, Adam) on at most ``max_lines`` lines
of all documents, found in one scan: half of them lines with a base match, whose
value is the secret, and half others, each the first by a hash of the line, one per
distinct line.  Of a line over ``LONGEST`` bytes a piece trains.  No labels are read.

Decoding is exact Viterbi.  A token is settled as outside when no transition
could make up for its scores; what lies between settled tokens is decoded
together for a whole batch.

Nulls and empty texts: no spans.  Offsets are code points, end exclusive.
Repeated rows get the same spans.  Without a base match to learn from, nothing is
added.  An empty table gives an empty result.  Extra columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, seal, texts, whole_text

ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    rb"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")  # a run of 16 or more is a whole run: same as [0-9a-f]+ kept from 16 on
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
KINDS = ("assign", "access", "hex", "crf")
MAX_LINES = 4_000
LONGEST = 1 << 16
MIN_CHARS = 8

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
_WORDS = 1 << 12
_SHAPES = 1 << 10
_GROUPS = (_SHAPES, _SHAPES, _SHAPES, _WORDS, _WORDS, _WORDS, _WORDS, 64, 16, 16, 16)
_BASE = np.r_[0, np.cumsum(_GROUPS)[:-1]]
N_FEATURES = sum(_GROUPS)
_CHUNK = 1 << 19


# --- base patterns ----------------------------------------------------------

def base_spans(data: bytes) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) in bytes, by start, then kind."""
    found = []
    low = data.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(data)
                  if m.end(2) - m.start(2) >= 12]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(data)
                  if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(data)]
    return sorted(found)


# --- tokens and features -----------------------------------------------------

def _tables():
    kind = np.full(256, 2, dtype=np.uint8)  # punctuation and control characters
    kind[[9, 10, 11, 12, 13, 32]] = 0
    word = np.zeros(256, dtype=bool)
    for a, b in ((48, 57), (65, 90), (97, 122), (128, 255)):
        word[a:b + 1] = True
    word[95] = True
    kind[word] = 1
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return kind, lower


_KIND, _LOWER = _tables()


def _bins(x: np.ndarray, edges: tuple) -> np.ndarray:
    return np.searchsorted(np.array(edges), x, "right")


def file_features(data: bytes) -> tuple[int, int, int]:
    """Bins of the document's digit share, punctuation share and line length."""
    size = max(1, len(data))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    marks = len(data) - len(data.translate(None, b"=:;{}()[]<>\"'#$%&*@|!"))
    lines = data.count(b"\n") + 1
    return (int(_bins(digits / size, (0.001, 0.005, 0.02, 0.1))), int(_bins(marks / size, (0.002, 0.01, 0.05, 0.15))),
            int(_bins(size / lines, (20, 60, 150, 400))))


class Tokens:
    """Tokens and feature numbers of some lines; ``pieces`` never break a line."""

    def __init__(self, pieces: list[bytes], files: list[tuple[int, int, int]]):
        data = np.frombuffer(b"\n".join([*pieces, b""]) + b"\0" * 8, dtype=np.uint8)
        size = len(data) - 8
        kind = _KIND[data[:size]]
        word = kind == 1
        begin = (word & ~np.r_[False, word[:-1]]) | (kind == 2)
        finish = (word & ~np.r_[word[1:], False]) | (kind == 2)
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(finish) + 1
        n = len(self.start)
        newline = np.cumsum(data[:size] == 10, dtype=np.int64)
        line = newline[self.start] if n else np.zeros(0, np.int64)
        sizes = np.fromiter((len(p) + 1 for p in pieces), dtype=np.int64, count=len(pieces))
        self.offset = np.r_[0, np.cumsum(sizes)]
        self.piece = np.searchsorted(self.offset, self.start, "right") - 1
        self.first = np.r_[True, line[1:] != line[:-1]] if n else np.zeros(0, bool)
        self.last = np.r_[self.first[1:], True] if n else self.first
        self.index = self._features(data, size, files)

    def _features(self, data, size, files):
        start, end, n = self.start, self.end, len(self.start)
        if not n:
            return np.zeros((0, len(_GROUPS)), dtype=np.int32)
        raw = data[:size]

        def count(mask):
            total = np.r_[0, np.cumsum(mask, dtype=np.int32)]
            return total[end] - total[start]

        length = end - start
        is_digit = (raw >= 48) & (raw <= 57)
        digits = count(is_digit)
        upper = count((raw >= 65) & (raw <= 90))
        low_hex = count((raw >= 97) & (raw <= 102))
        low = count((raw >= 97) & (raw <= 122))
        letter_digit = np.r_[False, is_digit[1:] != is_digit[:-1]]
        change = np.r_[0, np.cumsum(letter_digit, dtype=np.int32)]
        changes = change[end] - change[np.minimum(start + 1, end)]
        # kinds: no digit / digits only / hex / letters and digits; case; length; changes
        kind = np.where(digits == 0, 0, np.where(digits == length, 1, np.where(digits + low_hex == length, 2, 3)))
        case = np.where(upper == 0, 0, np.where(low == 0, 1, 2))
        size_bin = _bins(length, (2, 4, 8, 12, 16, 24, 40))
        shape = ((kind * 3 + case) * 8 + size_bin) * 4 + _bins(changes, (1, 3, 6))
        mark = (length == 1) & (_KIND[data[start]] == 2)
        shape = np.where(mark, 512 + data[start].astype(np.int64), shape)

        lowered = _LOWER[data]
        eight = np.ndarray(size, dtype="<u8", buffer=lowered.tobytes(), strides=(1,))
        keep = np.minimum(length, 8)
        mask = np.where(keep == 8, ~np.uint64(0), (np.uint64(1) << (keep * 8).astype(np.uint64) % np.uint64(64)) - np.uint64(1))
        key = eight[start] & mask
        key ^= eight[np.maximum(start, end - 8)] * np.uint64(0x9E3779B97F4A7C15) * (length > 8)
        key += length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
        key *= np.uint64(0xD6E8FEB86659FD93)
        word = (key >> np.uint64(52)).astype(np.int64) % (_WORDS - 1) + 1

        number = np.arange(n)
        line_first = np.maximum.accumulate(np.where(self.first, number, 0))
        line_last = np.minimum.accumulate(np.where(self.last, number, n)[::-1])[::-1]

        def beside(x, k, none=0):
            at = number + k
            ok = (at >= line_first) & (at <= line_last)
            return np.where(ok, x[np.clip(at, 0, n - 1)], none)

        space_before = np.r_[True, start[1:] > end[:-1]]
        space_after = np.r_[space_before[1:], True]
        around = (space_before * 2 + space_after) * 8 + beside(space_before, -1, 0) * 4 \
            + beside(space_before, -2, 0) * 2 + beside(space_after, 1, 0)
        of_file = np.array(files, dtype=np.int64).reshape(-1, 3)[self.piece]
        # a file feature counts by the token's rough kind: plain text or not
        plain = np.where((kind == 0) & ~mark, 0, np.where(mark, 1, 2))
        columns = [shape, beside(shape, -1, _SHAPES - 1), beside(shape, 1, _SHAPES - 1),
                   beside(word, -1), beside(word, -2), beside(word, -3), beside(word, 1), around,
                   *(np.minimum(of_file[:, k] * 3 + plain, 15) for k in range(3))]
        return np.stack([c + b for c, b in zip(columns, _BASE, strict=True)], axis=1).astype(np.int32)


def cut_lines(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Pieces of whole lines of about ``_CHUNK`` bytes, with their offsets."""
    at = 0
    while len(text) - at > _CHUNK:
        to = text.find(b"\n", at + _CHUNK)
        if to < 0:
            break
        yield at, text[at:to]
        at = to + 1
    yield at, text[at:]


# --- the model ------------------------------------------------------------------

class Chain:
    """Weights of the field; scores are relative to "outside" where that changes nothing."""

    def __init__(self):
        self.weights = np.zeros((N_FEATURES, 3))
        self.step = np.zeros((3, 3))
        self.open = np.zeros(3)
        self.close = np.zeros(3)

    def emissions(self, index: np.ndarray) -> np.ndarray:
        total = np.zeros((len(index), 3))
        for k in range(index.shape[1]):
            total += self.weights[index[:, k]]
        return total

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best tags of all lines (ties go to the lower tag)."""
        n = len(tokens.start)
        tags = np.zeros(n, dtype=np.int8)
        if not n:
            return tags
        score = self.emissions(tokens.index)
        score -= score[:, :1].copy()
        before = np.vstack([self.step, self.open])  # a row per previous tag, and the line's start
        after = np.hstack([self.step, self.close[:, None]])
        most = [(before[:, s] - before[:, 0]).max() + (after[s] - after[0]).max() for s in (BEGIN, INSIDE)]
        loose = (score[:, BEGIN] + most[0] > 0) | (score[:, INSIDE] + most[1] > 0)
        at = np.flatnonzero(loose)
        if not len(at):
            return tags
        new = np.r_[True, (np.diff(at) > 1) | tokens.first[at[1:]]]
        run = np.flatnonzero(new)
        start, size = at[run], np.diff(np.r_[run, len(at)])
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        end = start + size - 1
        best = np.where(tokens.first[start][:, None], self.open, self.step[OUTSIDE]) + score[start]
        back = []
        for t in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -t, "left"))  # runs of more than t tokens
            ways = best[:live, :, None] + self.step[None]
            back.append(ways.argmax(axis=1).astype(np.int8))
            best[:live] = ways.max(axis=1) + score[start[:live] + t]
        best += np.where(tokens.last[end][:, None], self.close, self.step[:, OUTSIDE])
        tag = best.argmax(axis=1).astype(np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -t, "left"))
            tags[start[:live] + t] = tag[:live]
            if t:
                tag[:live] = back[t - 1][np.arange(live), tag[:live]]
        return tags


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _gradient(chain: Chain, index: np.ndarray, tag: np.ndarray, size: np.ndarray):
    """Expected less observed counts of padded sequences (batch, time, features)."""
    count, longest = tag.shape
    score = chain.emissions(index.reshape(-1, index.shape[2])).reshape(count, longest, 3)
    inside = np.arange(longest) < size[:, None]
    rows = np.arange(count)
    forward = np.zeros((count, longest, 3))
    forward[:, 0] = chain.open + score[:, 0]
    for t in range(1, longest):
        forward[:, t] = _logsum(forward[:, t - 1, :, None] + chain.step, 1) + score[:, t]
    total = _logsum(forward[rows, size - 1] + chain.close, 1)
    backward = np.zeros((count, longest, 3))
    backward[rows, size - 1] = chain.close
    for t in range(longest - 2, -1, -1):
        value = _logsum(chain.step + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        live = t < size - 1
        backward[live, t] = value[live]
    chance = np.exp(forward + backward - total[:, None, None]) * inside[:, :, None]
    observed = np.eye(3)[tag] * inside[:, :, None]
    gap = (chance - observed)
    pair = np.zeros((3, 3))
    for t in range(longest - 1):
        live = t + 1 < size
        if not live.any():
            break
        joint = (forward[live, t, :, None] + chain.step + (score[live, t + 1] + backward[live, t + 1])[:, None, :]
                 - total[live, None, None])
        pair += np.exp(joint).sum(axis=0)
        np.subtract.at(pair, (tag[live, t], tag[live, t + 1]), 1)
    weights = np.zeros_like(chain.weights)
    flat = index[inside]
    for s in range(3):
        g = gap[:, :, s][inside]
        for k in range(flat.shape[1]):
            weights[:, s] += np.bincount(flat[:, k], weights=g, minlength=N_FEATURES)
    return weights, pair, gap[:, 0].sum(axis=0), gap[rows, size - 1].sum(axis=0)


def train(lines: list[tuple[bytes, list[tuple[int, int]], tuple[int, int, int]]], epochs: int = 12,
          batch: int = 64, rate: float = 0.1, decay: float = 1e-3, longest: int = 200,
          seed: int = 5) -> Chain:
    """Fit on (line, secret byte spans, file features); long lines are cut for training only."""
    chain = Chain()
    sequences = []
    for text, spans, file in lines:
        tokens = Tokens([text], [file])
        tag = np.zeros(len(tokens.start), dtype=np.int64)
        for a, b in spans:
            inner = np.flatnonzero((tokens.start >= a) & (tokens.start < b))
            tag[inner] = INSIDE
            tag[inner[:1]] = BEGIN
        for at in range(0, len(tag), longest):
            sequences.append((tokens.index[at:at + longest], tag[at:at + longest]))
    sequences = [s for s in sequences if len(s[1])]
    if not sequences:
        return chain
    rng = np.random.default_rng(seed)
    sequences.sort(key=lambda s: len(s[1]))
    groups = [sequences[i:i + batch] for i in range(0, len(sequences), batch)]
    state = [chain.weights, chain.step, chain.open, chain.close]
    first = [np.zeros_like(x) for x in state]
    second = [np.zeros_like(x) for x in state]
    turn = 0
    for epoch in range(epochs):
        for g in rng.permutation(len(groups)):
            size = np.array([len(t) for _, t in groups[g]])
            index = np.zeros((len(size), size.max(), len(_GROUPS)), dtype=np.int32)
            tag = np.zeros((len(size), size.max()), dtype=np.int64)
            for i, (x, t) in enumerate(groups[g]):
                index[i, :len(t)], tag[i, :len(t)] = x, t
            turn += 1
            for k, slope in enumerate(_gradient(chain, index, tag, size)):
                slope = slope / len(size) + decay * state[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                now = rate * (1 - epoch / epochs)
                state[k] -= now * first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-6)
    return chain


def _training_lines(k: int):
    """mapInArrow body: (text) -> the ``k`` lines with a base match and the ``k`` others that hash lowest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pools: tuple[dict, dict] = ({}, {})
        worst = [1 << 64, 1 << 64]

        def trim(rank: int) -> None:
            least = sorted(pools[rank])[:k]
            kept = {key: pools[rank][key] for key in least}
            pools[rank].clear()
            pools[rank].update(kept)
            if len(least) == k:
                worst[rank] = least[-1][0]

        for batch in batches:
            for data in texts(batch.column(0)):
                values = sorted((v, e) for _, _, e, v in base_spans(data))
                file = None
                at = nth = 0
                for line in data.split(b"\n"):
                    end = at + len(line)
                    own = []
                    while nth < len(values) and values[nth][0] < end:
                        own.append((values[nth][0] - at, values[nth][1] - at))
                        nth += 1
                    at = end + 1
                    rank = 0 if own else 1
                    place = xxhash.xxh64_intdigest(line, 42)
                    if not line or place > worst[rank]:
                        continue
                    if len(line) > LONGEST:  # a piece of it, with its first match
                        low = max(0, own[0][0] - LONGEST // 2) if own else 0
                        line = line[low:low + LONGEST]
                        own = [(x - low, min(y - low, LONGEST)) for x, y in own if x - low < LONGEST]
                    file = file or tuple(int(x) for x in file_features(data))
                    found, key = (file, tuple(own)), (place, line)
                    pools[rank][key] = min(pools[rank].get(key, found), found)
                    if len(pools[rank]) >= 2 * k:
                        trim(rank)
        for rank in (0, 1):
            trim(rank)
            rows = list(pools[rank].items())
            for i in range(0, len(rows), 256):
                part = rows[i:i + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rank] * len(part), pa.int32()), pa.array([x[0] - (1 << 63) for x, _ in part], pa.int64()),
                     pa.array([x[1] for x, _ in part], pa.binary()),
                     pa.array([list(f) for _, (f, _) in part], pa.list_(pa.int64())),
                     pa.array([[list(s) for s in o] for _, (_, o) in part], pa.list_(pa.list_(pa.int64())))],
                    names=["rank", "place", "line", "file", "spans"])

    return run


def fit(docs: DataFrame, text_col: str = "text", max_lines: int = MAX_LINES, **settings) -> Chain | None:
    """Train on at most ``max_lines`` lines of all documents; None if no line has a match."""
    k = max(1, max_lines // 2)
    lines = docs.select(whole_text(text_col).alias("_text")).mapInArrow(
        _training_lines(k), "rank int, place long, line binary, file array<bigint>, spans array<array<bigint>>")
    # one row per line: a line that all documents hold is one line
    lines = cut(lines.groupBy("rank", "place", "line").agg(F.min(F.struct("file", "spans")).alias("_of")),
                "secret-lines")
    found = [(bytes(r[0]), [tuple(s) for s in r[1]], tuple(r[2])) for rank in (0, 1) for r in
             lines.where(F.col("rank") == rank).orderBy("place", "line").limit(k)
             .select("line", "_of.spans", "_of.file").collect()]
    if not any(s for _, s, _ in found):
        return None
    return train(found, **settings)


# --- operator ------------------------------------------------------------------

FOUND = "spans array<struct<kind:string,start:long,end:long>>"


def find_spans(documents: list[bytes], chain: Chain | None) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) in code points for each text, by start, then kind."""
    base = [base_spans(d) for d in documents]
    added: list[list[tuple[int, int]]] = [[] for _ in documents]
    if chain is not None:
        work: list[tuple[int, int, bytes]] = []
        held = 0
        files = [file_features(d) for d in documents]

        def flush():
            tokens = Tokens([p for _, _, p in work], [files[k] for k, _, _ in work])
            tags = chain.decode(tokens)
            secret = np.flatnonzero(tags)
            if len(secret):
                new = np.r_[True, (np.diff(secret) > 1) | (tags[secret[1:]] == BEGIN) | tokens.first[secret[1:]]]
                for a, b in zip(secret[new], secret[np.r_[new[1:], True]], strict=True):
                    k, at, _ = work[tokens.piece[a]]
                    shift = at - int(tokens.offset[tokens.piece[a]])
                    added[k].append((int(tokens.start[a]) + shift, int(tokens.end[b]) + shift))
            work.clear()

        for k, data in enumerate(documents):
            for at, piece in cut_lines(data):
                work.append((k, at, piece))
                held += len(piece)
                if held >= _CHUNK:
                    flush()
                    held = 0
        if work:
            flush()
    out = []
    for data, fixed, more in zip(documents, base, added, strict=True):
        spans = [(s, k, e) for s, k, e, _ in fixed]
        spans += [(a, 3, b) for a, b in more if b - a >= MIN_CHARS
                  and not any(s < b and a < e for s, _, e, _ in fixed)]
        if spans and not data.isascii():
            follow = np.r_[0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) == 0x80)]
            spans = [(s - int(follow[s]), k, e - int(follow[e])) for s, k, e in spans]
        out.append(sorted(spans))
    return out


def scan(docs: DataFrame, chain: Chain | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end), by start, then kind; a column of that name is replaced."""
    docs, (text_col,), unseal = seal(docs, text_col)
    rows = docs.withColumn("_text", whole_text(text_col))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = find_spans(list(texts(batch.column(batch.num_columns - 1))), chain)
            value = pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in spans], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, value], names=[*batch.schema.names, "spans"])

    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string(FOUND).fields])
    return unseal(rows.mapInArrow(run, schema), "spans")
