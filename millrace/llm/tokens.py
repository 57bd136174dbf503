"""Token ids of whole texts with a public tokenizer, fast enough for a corpus.

The byte-level pre-tokenizer always begins a new piece at a single space
between two characters that are not white space. So a text may be cut there,
each piece encoded by the library on its own and the ids joined, and they are
the ids of the whole text. Pieces repeat: a batch's distinct pieces are encoded
once, many in one text, and told apart by the bytes of their tokens. Short pieces
that a batch holds twice are remembered for the batches after it, up to a bound.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import per_worker

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"

# Bytes of a piece that is remembered, at most.
_SHORT = 32

# White space other than the space and the line feed, which the cut must not touch.
_OTHER = "\t\r\v\f\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_ODD = rf"  | \n|\n |\A[ \n]|[ \n]\z|[{_OTHER}]"
_CUT = re.compile(r"(?<=\S)(?= \S)")


def tokenizer_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable letter by which byte-level tokenizers write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def cut(texts: pa.Array, whole: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts (large strings, no nulls), and the n+1 offsets of each text's; those of ``whole`` stay uncut.

    The space at which a piece begins is left out, but for a text's first piece.
    """
    lists = pc.split_pattern(texts, " ")
    values, at = lists.flatten(), np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
    special = np.zeros(len(texts), bool) if whole is None else whole
    odd = np.asarray(pc.match_substring_regex(texts, _ODD)) | special
    if not odd.any():
        return values, at
    # Texts with uncommon white space are cut again, at safe places only.
    parts, sizes = [], np.diff(at)
    done = 0
    for row in np.flatnonzero(odd):
        parts.append(values.slice(at[done], at[row] - at[done]))
        text = texts[int(row)].as_py()
        split = [text] if special[row] else [p[1:] if k else p for k, p in enumerate(_CUT.split(text))]
        parts.append(pa.array(split, values.type))
        sizes[row] = len(split)
        done = row + 1
    parts.append(values.slice(at[done], at[-1] - at[done]))
    return pa.concat_arrays(parts), np.concatenate([[0], np.cumsum(sizes)])


class Encoder:
    """Texts to unsigned 32-bit ids, without special tokens added."""

    def __init__(self, path: str, together: int = 2_000, remember: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._together = Tokenizer.from_file(path), together
        special = [re.escape(t.content) for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = "|".join(special) or r"\A\z."
        vocabulary = self._tokenizer.get_vocab()
        # Byte-level entries have a letter for each byte.
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self._bytes[list(vocabulary.values())] = list(map(len, vocabulary))
        # Pieces that followed a space in earlier batches; where their ids begin, how many, and all ids.
        self._remember, self._known = remember, pa.array([], pa.large_string())
        self._starts, self._lengths, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n+1 offsets at which each text's ids begin; nulls have none."""
        if len(column) == 0:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        texts = column.cast(pa.large_string()).fill_null("")
        values, at = cut(texts, np.asarray(pc.match_substring_regex(texts, self._special)))
        later = np.ones(len(values), bool)
        later[at[:-1]] = False
        after, first = values.filter(pa.array(later)).dictionary_encode(), values.take(pa.array(at[:-1])).dictionary_encode()
        codes = np.empty(len(values), np.int32)
        codes[later] = np.asarray(after.indices)
        codes[at[:-1]] = np.asarray(first.indices) + len(after.dictionary)
        del values, later
        often = np.bincount(np.asarray(after.indices), minlength=len(after.dictionary)) > 1
        ids, starts, lengths = self._recall(after.dictionary, first.dictionary, often)
        taken = lengths[codes]
        ends = np.cumsum(taken, dtype=np.int64)
        # Places fit 32 bits unless one text is huge.
        width = np.int32 if ends[-1] < 1 << 31 else np.int64
        place = np.repeat((starts[codes] - ends + taken).astype(width), taken)
        place += np.arange(len(place), dtype=width)
        return ids[place], np.concatenate([[0], ends[at[1:] - 1]])

    def _recall(self, after: pa.Array, first: pa.Array, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_pool``, which encodes the pieces that are not remembered; short ones marked ``often`` will be."""
        place = np.asarray(pc.index_in(after, value_set=self._known).fill_null(-1))
        fresh = place < 0
        new, new_starts, new_lengths = self._pool(after.filter(pa.array(fresh)), first)
        ids, n = np.concatenate([self._ids, new]), len(self._ids)
        starts, lengths = np.empty(len(after) + len(first), np.int64), np.empty(len(after) + len(first), np.int64)
        old, coded = np.flatnonzero(~fresh), np.concatenate([np.flatnonzero(fresh), np.arange(len(after), len(starts))])
        starts[old], lengths[old] = self._starts[place[old]], self._lengths[place[old]]
        starts[coded], lengths[coded] = new_starts + n, new_lengths
        often = often & (np.asarray(pc.binary_length(after)) <= _SHORT)
        chosen = np.flatnonzero(often & fresh)
        if len(self._known) + len(chosen) <= self._remember:
            self._known = pa.concat_arrays([self._known, after.take(pa.array(chosen))])
            kept = [np.concatenate(x) for x in ((self._starts, starts[chosen]), (self._lengths, lengths[chosen]))]
        else:
            # No room: the batch's own take the place of all.
            chosen = np.flatnonzero(often)[: self._remember]
            self._known = after.take(pa.array(chosen))
            kept = [starts[chosen], lengths[chosen]]
        ends = np.cumsum(kept[1])
        self._starts, self._lengths = ends - kept[1], kept[1]
        self._ids = ids[np.repeat(kept[0] - self._starts, kept[1]) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, starts, lengths

    def _pool(self, after: pa.Array, first: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct pieces, those that follow a space and then the first ones: where each one's begin, how many."""
        pieces, sizes = after.to_pylist(), np.asarray(pc.binary_length(after), np.int64) + 1
        # Pieces that do not end in white space may follow each other in one text.
        solid = np.fromiter((not p[-1:].isspace() for p in pieces), bool, len(pieces))
        runs, alone = np.flatnonzero(solid), np.flatnonzero(~solid)
        parts = [runs[k : k + self._together] for k in range(0, len(runs), self._together)]
        texts = [" " + " ".join(map(pieces.__getitem__, part.tolist())) for part in parts]
        single = [" " + pieces[k] for k in alone.tolist()] + first.to_pylist()
        got = [np.array(e.ids, np.uint32) for e in self._tokenizer.encode_batch_fast(texts + single, add_special_tokens=False)]
        lengths = np.zeros(len(pieces) + len(first), np.int64)
        for part, ids in zip(parts, got):
            lengths[part] = np.diff(np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(sizes[part]), "right"), prepend=0)
        order = np.concatenate([runs, alone, np.arange(len(pieces), len(lengths))])
        lengths[order[len(runs) :]] = [len(ids) for ids in got[len(parts) :]]
        starts = np.empty(len(lengths), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.concatenate([np.zeros(0, np.uint32), *got]), starts, lengths


def encoder(path: str) -> Encoder:
    """The worker's encoder. What it remembers from batch to batch is bounded, and changes no ids."""
    return per_worker(f"encoder {path}", lambda: Encoder(path), large=True)
