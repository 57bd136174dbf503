"""Vectorised word work over whole Arrow batches of texts.

A batch's texts lie in one buffer; all functions here work on that buffer, so
no Python object is made for a word. White space is the six ASCII characters
x09-x0D and x20, hence bytes can be told apart without decoding UTF-8.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of every word rule, as a class inside brackets.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def _kept() -> dict[str, Any]:
    return sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker")).__dict__


def per_worker(key: str, make: Callable[[], Any], large: bool = False) -> Any:
    """A value kept as long as the Python worker lives.

    Functions reach the workers by value, so a module's own globals would be
    made anew for each task. A ``large`` value goes with the first task that
    reads ``pieces`` and has not asked for it before.
    """
    kept = _kept()
    if key not in kept:
        kept[key] = make()
    if large:
        kept.setdefault("large values", {})[key] = True
    return kept[key]


def _drop_large() -> None:
    """Drop the large values no one has asked for since this was last called."""
    kept = _kept()
    asked = kept.setdefault("large values", {})
    for key in [k for k, wanted in asked.items() if not wanted]:
        del kept[key], asked[key]
    asked.update(dict.fromkeys(asked, False))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a one-to-one mapping)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _make_tables() -> dict[str, np.ndarray]:
    byte = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    lower = byte.copy()
    lower[65:91] = byte[97:123]
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return {"byte": byte, "lower": lower, "space": space, "up": _powers(int(_BASE), _BLOCK),
            "down": _powers(pow(int(_BASE), -1, 1 << 64), _BLOCK)}


def _table(name: str) -> np.ndarray:
    """Look-up tables by byte (hash values, white space) and by position (powers)."""
    return per_worker("text tables", _make_tables)[name]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n+1 offsets of its rows; nulls count as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


@dataclass
class Words:
    """The words of a batch: hash, byte span, and where each text's words begin."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # n+1 offsets into the words

    def of(self, row: int) -> np.ndarray:
        return self.hashes[self.first[row] : self.first[row + 1]]


def words_of(raw: np.ndarray, at: np.ndarray, lower: bool = True) -> Words:
    """Split every text into words and hash each (A-Z as a-z if ``lower``)."""
    solid = ~_table("space")[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at[(at > 0) & (at < len(raw))]] = True
    before = np.empty(len(raw), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return Words(_spans(raw, starts, ends, lower), starts, ends, np.searchsorted(starts, at))


def _spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Polynomial hash of each span, from running sums over blocks of the buffer."""
    table, out = _table("lower" if lower else "byte"), np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        low = starts[done]
        stop = max(np.searchsorted(ends, low + _BLOCK, "right"), done + 1)
        high = ends[stop - 1]
        if high - low > _BLOCK:  # one very long word
            value = np.uint64(0)
            for k in range(low, high, _BLOCK):
                part = table[raw[k : min(k + _BLOCK, high)]]
                value = mix(np.array([value + (part * _table("up")[: len(part)]).sum()]))[0]
            out[done] = value
        else:
            part = table[raw[low:high]] * _table("up")[: high - low]
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=total[1:])
            a, b = starts[done:stop] - low, ends[done:stop] - low
            out[done:stop] = (total[b] - total[a]) * _table("down")[a]
        done = stop
    return mix(out ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one run; none without words."""
    n = len(words)
    if n == 0:
        return words
    runs = max(n - size + 1, 1)
    out = np.full(runs, min(n, size), np.uint64)
    for k in range(min(n, size)):
        out = mix(out * np.uint64(0x100000001B3) + words[k : k + runs])
    return out


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = _BLOCK) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most about ``most`` bytes of text, or one row."""
    _drop_large()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        at = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))])
        low = 0
        while low < batch.num_rows:
            high = max(int(np.searchsorted(at, at[low] + most, "right")) - 1, low + 1)
            yield batch.slice(low, high - low)
            low = high
    # A worker runs one step after another; what the batches of this one took is not kept.
    pa.default_memory_pool().release_unused()


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Put batches together up to about ``most`` bytes, so that more of their words repeat."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)
