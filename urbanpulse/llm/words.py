"""Words of whole texts as numbers, for the operators that compare runs of words.

A word is a longest run of bytes other than space and \\x09 to \\x0D.  Texts are taken
in chunks of bounded size (a longer text is a chunk of its own), so the memory of a
task follows the longest text and not the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import texts

CHUNK_BYTES = 1 << 20
WHITE = b" \t\n\x0b\x0c\r"


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """The texts of a column in lists of about ``size`` bytes."""
    held, total = [], 0
    for text in texts(column):
        held.append(text)
        total += len(text)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def number_words(split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number per word, equal for equal words of a chunk, and the n+1 offsets of the texts."""
    known: dict[bytes, int] = {}
    name = known.setdefault
    ids = [name(w, len(known)) for words in split for w in words]
    starts = np.zeros(len(split) + 1, dtype=np.int64)
    np.cumsum([len(words) for words in split], out=starts[1:])
    return np.array(ids, dtype=np.int64), starts


def repeated_windows(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Where a window of ``size`` words starts that occurs twice or more in its text, in order.

    Candidates come from sorted hashes and are compared word by word.
    """
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    at = np.flatnonzero(owner[:n] == owner[size - 1:])
    factor = np.random.default_rng(size).integers(1, 1 << 62, size + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plain = ids.astype(np.uint64) + np.uint64(1)
    key = owner[:n].astype(np.uint64) * factor[size]
    for j in range(size):
        key += plain[j:n + j] * factor[j]
    key = key[at]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twin = np.r_[False, same] | np.r_[same, False]
    found = at[order[twin]]
    if not len(found):
        return found
    lead = found[np.maximum.accumulate(np.where(np.r_[False, same][twin], 0, np.arange(len(found))))]
    equal = owner[found] == owner[lead]
    for j in range(size):
        equal &= ids[found + j] == ids[lead + j]
    if not equal.all():  # a hash met two windows: count the windows themselves
        whole = np.stack([owner[found], *(ids[found + j] for j in range(size))], axis=1)
        _, label, count = np.unique(whole, axis=0, return_inverse=True, return_counts=True)
        found = found[count[label.ravel()] > 1]
    return np.sort(found)
