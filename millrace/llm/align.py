"""Alignment of two tokenizers' tokens, and how many documents link each pair of ids.

Both tokenizers cut the same bytes. Where a token of each ends, a group ends;
tokens whose bytes overlap are linked. Two passes read the texts:

1. Align, and fold the pairs linked in each document to partial counts per task.
   The distinct pairs are dealt to shards by hash, and each shard gets a minimal
   perfect hash function: every pair has a slot of its own, and no slot is
   empty. Tasks add their partial counts to dense vectors indexed by slot, and
   the vectors are summed as a tree. Beside the sums lies each slot's key.
2. Align again and look each pair's count up at its slot, verified by its key.

Texts are cut at single spaces, where both tokenizers always cut too, and of a
batch's pieces each is encoded and aligned once. The byte-level merges are run
by tiktoken with the tokenizer file's own vocabulary, whose ids are the order of
its merges; tests compare with the tokenizers library on whole texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .text import gathered, mix, pieces
from .tokens import _byte_letters, cut

# Fixed value: the character that stands for a space in pieces of the second tokenizer.
SPACE = "▁"

# Fixed value: how byte-level tokenizers of this kind cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A pair of ids in one number; ids stay below 2^20.
_SHIFT = np.int64(20)
_BATCH = 8 << 20


# ---- minimal perfect hashing ----


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _slots(keys: np.ndarray, level: int, sizes: np.ndarray | int) -> np.ndarray:
    seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))
    return (mix(mix(keys.astype(np.uint64) + seed) ^ seed) % np.asarray(sizes, np.uint64)).astype(np.int64)


def build(keys: np.ndarray, spread: float = 2.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """A minimal perfect hash function of distinct keys, and the keys in the order of their slots.

    In each level the keys left are thrown into ``spread`` times as many bits; a
    bit hit by one key is that key's for good, the others go to the next level.
    A key's slot is the number of bits set before its own. Returns the sizes of
    the levels (whole 64-bit words), the words of all levels, the keys by slot.
    """
    sizes, words, order, left = [], [], [], keys
    while len(left):
        size = -(-int(len(left) * spread) // 64) * 64
        slot = _slots(left, len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        mine = alone[slot]
        order.append(left[mine][np.argsort(slot[mine])])
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~mine]
    none = np.zeros(0, np.uint64), keys[:0]
    return sizes, *((np.concatenate(words), np.concatenate(order)) if sizes else none)


class Slots:
    """The functions of a range of shards: pairs to places in one dense vector."""

    def __init__(self, low: int, sizes: list[list[int]], words: list[np.ndarray], shards: int):
        self.low, self.shards, self.n = low, shards, len(sizes)
        depth = max([1, *map(len, sizes)])
        self.sizes = np.zeros((len(sizes), depth), np.int64)
        for row, s in zip(self.sizes, sizes):
            row[: len(s)] = s
        flat = np.concatenate([np.zeros(0, np.uint64), *words])
        ends = np.cumsum(self.sizes.ravel()).reshape(self.sizes.shape)
        self.starts = ends - self.sizes
        self.words = flat
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(flat), dtype=np.int64)])
        self.size = int(self.before[-1])
        #: where each shard's slots begin, and one more
        self.first = np.append(self.before[self.starts[:, 0] >> 6], self.size) if len(sizes) else np.zeros(1, np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place, -1 for keys of other shards; a key that was not built in may get any place."""
        out, shard = np.full(len(keys), -1, np.int64), shard_of(keys, self.shards) - self.low
        left = np.flatnonzero((shard >= 0) & (shard < self.n))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[shard[left], level]
            left, size = left[size > 0], size[size > 0]
            at = self.starts[shard[left], level] + _slots(keys[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            inner = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[at >> 6] + inner)[hit]
            left = left[~hit]
        return out


# ---- alignment ----


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        known, byte = Tokenizer.from_file(path_a), {letter: b for b, letter in _byte_letters().items()}
        added = {t.content for t in known.get_added_tokens_decoder().values()}
        of_a = {i: bytes(map(byte.__getitem__, entry)) for entry, i in known.get_vocab(with_added_tokens=False).items() if entry not in added}
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={raw: i for i, raw in of_a.items()}, special_tokens={})
        self._b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [of_a.get(i, b"") for i in range(max(of_a) + 1)]
        self.bytes_b = [self._piece(i) for i in range(self._b.get_piece_size())]
        self._size_a, self._size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self._b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which texts the tokens give back, and of both tokenizers: number of tokens a text, all ids."""
        raw = [t.encode() for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        # Texts that do not end in white space may follow each other in one call.
        solid = np.fromiter((not t[-1].isspace() for t in texts), bool, len(texts))
        order = np.concatenate([np.flatnonzero(solid), np.flatnonzero(~solid)])
        ids, met, joined = [], 0, int(solid.sum())
        runs = [order[k : min(k + 20_000, joined)] for k in range(0, joined, 20_000)] + [order[k : k + 1] for k in range(joined, len(order))]
        n_a = np.zeros(len(texts), np.int64)
        for run in runs:
            got = np.array(self._a.encode_ordinary("".join([texts[k] for k in run.tolist()])), np.int64)
            upto = np.searchsorted(np.cumsum(self._size_a[got]), np.cumsum(size[run]), "right")
            n_a[run] = np.diff(upto, prepend=0)
            ids.append(got)
            met += len(got)
        a = np.concatenate([np.zeros(0, np.int64), *ids])
        starts = np.empty(len(texts), np.int64)
        starts[order] = np.cumsum(n_a[order]) - n_a[order]
        a = a[_spans(starts, n_a)]
        lists = self._b.encode([t[1:] for t in texts], num_threads=1) if texts else []
        n_b = np.fromiter(map(len, lists), np.int64, len(lists))
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(n_b.sum()))
        return self._same(raw, n_a, a, self.bytes_a) & self._same(raw, n_b, b, self.bytes_b), n_a, a, n_b, b

    @staticmethod
    def _same(raw: list[bytes], n: np.ndarray, ids: np.ndarray, known: list[bytes]) -> np.ndarray:
        parts, ends = list(map(known.__getitem__, ids.tolist())), np.cumsum(n).tolist()
        total = np.append(0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))))
        at = total[np.cumsum(n)]
        if b"".join(parts) == b"".join(raw) and (at == np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))).all():
            return np.ones(len(raw), bool)
        return np.array([b"".join(parts[s:e]) == r for s, e, r in zip([0, *ends], ends, raw)], bool)

    def __call__(self, texts: list[str], written: bool = True) -> dict[str, np.ndarray | list[str]]:
        """Align texts that each begin with a space, which the second tokenizer adds by itself.

        Per text: whether it has tokens (``fine``), their numbers, those of
        groups and links, the groups written out (if ``written``); and all
        ``links`` (first id << 20 | second id), text after text.
        """
        fine, n_a, a, n_b, b = self._encode(texts)
        if not fine.all():
            a, b = a[np.repeat(fine, n_a)], b[np.repeat(fine, n_b)]
            n_a, n_b = n_a * fine, n_b * fine
        end_a, end_b = np.cumsum(self._size_a[a]), np.cumsum(self._size_b[b])
        # Each stretch between neighbouring ends lies in one token of either kind: a link.
        ends = np.sort(np.concatenate([end_a, end_b]))
        ends = ends[np.diff(ends, append=-1) != 0]
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        links = a[at_a] << _SHIFT | b[at_b]
        both = (end_a[at_a] == ends) & (end_b[at_b] == ends)  # groups end here
        stop = np.searchsorted(ends, np.append(0, end_a)[np.cumsum(n_a)], "right")
        first = np.append(0, stop)[:-1]
        upto = np.append(0, np.cumsum(both))
        out = {"fine": fine, "n_a": n_a, "n_b": n_b, "n_groups": upto[stop] - upto[first], "n_links": stop - first, "links": links}
        if written:
            each = self._groups(a, b, at_a[both] + 1, at_b[both] + 1)
            out["groups"] = [";".join(each[s:e]) for s, e in zip(upto[first].tolist(), upto[stop].tolist())]
        return out

    @staticmethod
    def _groups(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> list[str]:
        a, b, out, i, j = list(map(str, a.tolist())), list(map(str, b.tolist())), [], 0, 0
        for m, n in zip(ends_a.tolist(), ends_b.tolist()):
            out.append(f"{a[i] if m == i + 1 else ','.join(a[i:m])}|{b[j] if n == j + 1 else ','.join(b[j:n])}")
            i, j = m, n
        return out

    def read(self, column: pa.Array, written: bool = True) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
        """What is known of a batch's distinct pieces; all texts' piece numbers, their n+1 offsets, which texts have tokens."""
        texts = column.cast(pa.large_string()).fill_null("")
        some = np.asarray(pc.binary_length(texts)) > 0
        values, at = cut(texts)
        coded = values.dictionary_encode()
        known = self([" " + t for t in coded.dictionary.to_pylist()], written)
        codes = np.asarray(coded.indices).astype(np.int64)
        wrong = np.append(0, np.cumsum(~known["fine"][codes]))
        return known, codes, at, some & (wrong[at[1:]] == wrong[at[:-1]])


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all members of spans, span after span."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[at[1:]] - total[at[:-1]]


def _counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    values = np.sort(values)
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return values[first], np.diff(first, append=len(values))


def _linked(known: dict, codes: np.ndarray, at: np.ndarray, fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a batch, and how many of its texts link each."""
    links, sizes = known["links"], known["n_links"]
    pairs, of = np.unique(links, return_inverse=True)
    rows = np.repeat(np.arange(len(fine)), np.diff(at))
    row, piece = np.divmod(_counts((rows * max(len(sizes), 1) + codes)[fine[rows]])[0], max(len(sizes), 1))
    met = np.repeat(row, sizes[piece]) * max(len(pairs), 1) + of[_spans((np.cumsum(sizes) - sizes)[piece], sizes[piece])]
    n = np.bincount(_counts(met)[0] % max(len(pairs), 1), minlength=len(pairs))
    return pairs[n > 0], n[n > 0]


# ---- passes ----


def count_pairs(texts: DataFrame, path_a: str, path_b: str, fold: int = 1 << 20) -> DataFrame:
    """Partial counts (pair, n) of the texts of column ``text`` that link a pair, folded in each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held, size = Aligner(path_a, path_b), [], 0

        def folded() -> pa.RecordBatch:
            pairs, of = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, of, np.concatenate([c for _, c in held]))
            held[:] = [(pairs, n)]
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

        for batch in pieces(gathered(batches, _BATCH), "text", _BATCH):
            held.append(_linked(*aligner.read(batch.column("text"), written=False)))
            size += len(held[-1][0])
            if size > 2 * fold:
                full = folded()
                size = full.num_rows
                if size > fold:
                    yield full
                    held, size = [], 0
        if held:
            yield folded()

    return texts.select("text").mapInArrow(count, "pair bigint, n bigint")


def perfect_hash(pairs: DataFrame, shards: int) -> DataFrame:
    """Rows (shard, sizes, words, keys): a minimal perfect hash function of each shard of the distinct ``pair``."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("pair")
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(keys.to_numpy(), shards).astype(np.int32)), keys], ["shard", "pair"])

    def make(group: pa.Table) -> pa.Table:
        sizes, words, keys = build(group["pair"].to_numpy())
        return pa.table({"shard": group["shard"].slice(0, 1), "sizes": [sizes], "words": [words.view(np.int64)], "keys": [keys]})

    keyed = pairs.select("pair").distinct().mapInArrow(dealt, "shard int, pair bigint")
    return keyed.groupBy("shard").applyInArrow(make, "shard int, sizes array<bigint>, words array<bigint>, keys array<bigint>")


def _fetched(rows: DataFrame, low: int, high: int, shards: int, *more: str) -> tuple[Slots, list[np.ndarray]]:
    """The functions of the shards from ``low`` to before ``high``, and their columns ``more``, each as one vector by slot."""
    found = rows.where(F.col("shard").between(low, high - 1)).select("shard", "sizes", "words", *more).toArrow()
    at = {s: k for k, s in enumerate(found["shard"].to_pylist())}  # a shard without keys has no row
    empty = np.zeros(0, np.int64)

    def inside(name: str) -> list[np.ndarray]:
        return [found[name][at[s]].values.to_numpy() if s in at else empty for s in range(low, high)]

    slots = Slots(low, inside("sizes"), [w.view(np.uint64) for w in inside("words")], shards)
    return slots, [np.concatenate(inside(name)) for name in more]


def _restored(state: dict) -> Slots:
    slots = Slots.__new__(Slots)
    slots.__dict__ = state
    return slots


def dense_counts(partials: DataFrame, functions: DataFrame, shards: int, together: int, fan: int = 16) -> DataFrame:
    """Rows (shard, counts): the partial counts (pair, n) summed by slot.

    Each task adds to dense vectors, one a shard; ``fan`` vectors at a time are
    summed, level by level. The functions (a few bits a pair) are shared with
    the tasks for ``together`` shards at a time.
    """
    context, parts = partials.sparkSession.sparkContext, partials.rdd.getNumPartitions()
    out = None
    for low in range(0, shards, together):
        high = min(low + together, shards)
        shared = context.broadcast(_fetched(functions, low, high, shards)[0].__dict__)

        def add(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            slots = _restored(shared.value)
            total = np.zeros(slots.size, np.int64)
            for batch in batches:
                at = slots(batch.column("pair").to_numpy())
                np.add.at(total, at[at >= 0], batch.column("n").to_numpy()[at >= 0])
            part = TaskContext.get().partitionId()
            for k in range(slots.n):
                own = total[slots.first[k] : slots.first[k + 1]]
                if own.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([slots.low + k], pa.int32()), pa.array([part], pa.int32()), pa.array([own], pa.list_(pa.int64()))],
                        ["shard", "part", "counts"])

        def summed(group: pa.Table) -> pa.Table:
            lists = group["counts"].combine_chunks()
            total = np.asarray(lists.flatten()).reshape(len(lists), -1).sum(axis=0)
            return pa.table({"shard": group["shard"].slice(0, 1), "part": group["part"].slice(0, 1), "counts": pa.array([total], pa.list_(pa.int64()))})

        kind = "shard int, part int, counts array<bigint>"
        vectors, left = partials.mapInArrow(add, kind), parts
        while True:
            vectors = vectors.withColumn("part", (F.col("part") / fan).cast("int")).groupBy("shard", "part").applyInArrow(summed, kind)
            left = -(-left // fan)
            if left <= 1:
                break
        vectors = settle(vectors.select("shard", "counts"))
        shared.unpersist()
        out = vectors if out is None else out.unionByName(vectors)
    return out


def highest(table: DataFrame) -> dict[int, int]:
    """Of each first id the highest count of its pairs; one entry for each id of a vocabulary at most."""

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = np.asarray(batch.column("keys").flatten()) >> _SHIFT
            n = np.asarray(batch.column("counts").flatten())
            order = np.lexsort((n, a))
            last = order[np.append(np.diff(a[order]) > 0, True)] if len(order) else order
            yield pa.RecordBatch.from_arrays([pa.array(a[last]), pa.array(n[last])], ["a", "n"])

    top = table.select("keys", "counts").mapInArrow(most, "a bigint, n bigint").groupBy("a").agg(F.max("n").alias("n"))
    return {r["a"]: r["n"] for r in top.collect()}


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id", shard_keys: int = 1 << 16,
          at_once: int = 64) -> DataFrame:
    """Per document (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A null or empty text, and one that the tokens' bytes do not give back, has
    no tokens: zeros and ''. Repeated rows are documents of their own, a null
    id stays null, other columns are not read, and an empty table gives no rows.

    Counts of ``at_once`` shards of about ``shard_keys`` pairs (16 bytes a pair)
    are shared with the tasks at a time. Where there are more shards, further
    passes over the texts add the counts of the next ones.
    """
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    partials = settle(count_pairs(texts, path_a, path_b))
    distinct = partials.select("pair").distinct().count()
    shards = max(-(-distinct // shard_keys), 1)
    functions = settle(perfect_hash(partials, shards))
    table = settle(functions.join(dense_counts(partials, functions, shards, at_once), "shard"))
    best = highest(table)
    top = np.zeros(max([0, *best]) + 1, np.int64)
    top[list(best)] = list(best.values())
    digest = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = texts
    for low in range(0, shards, at_once):
        slots, (keys, counts) = _fetched(table, low, min(low + at_once, shards), shards, "keys", "counts")
        shared = context.broadcast((slots.__dict__, keys, counts, top))
        last = low + at_once >= shards

        def look_up(batches: Iterator[pa.RecordBatch], first=low == 0, last=last, shared=shared) -> Iterator[pa.RecordBatch]:
            state, keys, counts, top = shared.value
            slots = _restored(state)

            aligner = Aligner(path_a, path_b)
            for batch in pieces(gathered(batches, _BATCH), "text", _BATCH):
                known, codes, at, fine = aligner.read(batch.column("text"), written=last)
                links, ends = known["links"], np.append(0, np.cumsum(known["n_links"]))
                place = slots(links)
                mine = np.flatnonzero(place >= 0)
                mine = mine[keys[place[mine]] == links[mine]]
                count, is_best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                count[mine] = counts[place[mine]]
                is_best[mine] = count[mine] == top[links[mine] >> _SHIFT]
                known |= {"n_best": _sums(is_best, ends), "count_sum": _sums(count, ends)}
                out = {c: np.where(fine, _sums(known[c][codes], at), 0) for c in digest[1:-1]}
                if not first:
                    for c in ("n_best", "count_sum"):
                        out[c] += batch.column(c).to_numpy()
                columns = [batch.column("doc_id"), *map(pa.array, out.values())]
                if last:
                    group, cells = known["groups"].__getitem__, codes.tolist()
                    columns.append(pa.array([hashlib.sha256(";".join(map(group, cells[s:e])).encode()).hexdigest() if f else ""
                                             for s, e, f in zip(at.tolist(), at[1:].tolist(), fine.tolist())], pa.string()))
                else:
                    columns.append(batch.column("text"))
                yield pa.RecordBatch.from_arrays(columns, digest[:-1] + (digest[-1:] if last else ["text"]))

        rows = rows.mapInArrow(look_up, ", ".join(f"{c} bigint" for c in digest[:-1]) + (f", {digest[-1]} string" if last else ", text string"))
        if not last:
            rows = settle(rows)
    return rows
