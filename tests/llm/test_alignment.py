import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import align
from millrace.llm.queries import QUERIES
from millrace.llm.tokens import PIECE_BPE, tokenizer_path

from .cases import SF, edge_rows, edges, empty

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
A, B = tokenizer_path(), tokenizer_path(PIECE_BPE)
ALIGNER = align.Aligner(A, B)
WHOLE = tokenizers.Tokenizer.from_file(A)
WHOLE.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)

ODD = ["x▁y", "<|endoftext|> a <|endoftext|>", "<s> </s> <0x0A> <unk>", "a  b   c", " lead", "trail  ", "a\n\nb \n c", "\x00 \x1c x", "é é ﬁ 日本 語 🙂🙂",
       "it's 1234567 ....!!! aaaaaaaa", "\xa0x \xa0 y", " ", "\n"]


def tokens(text):
    """Ids and bytes of whole texts by both tokenizers, or none."""
    raw = (" " + (text or "")).encode()
    a = WHOLE.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
    b = PIECES.encode(text) if text else []
    bytes_a = [ALIGNER.bytes_a[i] for i in a]
    bytes_b = [ALIGNER.bytes_b[i] for i in b]
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return [], []
    return list(zip(a, np.cumsum(list(map(len, bytes_a))).tolist())), list(zip(b, np.cumsum(list(map(len, bytes_b))).tolist()))


def links_of(a, b):
    """All pairs with overlapping bytes, walking both lists."""
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        out.append((a[i][0], b[j][0]))
        x, y = a[i][1], b[j][1]
        i, j = i + (x <= y), j + (y <= x)
    return out


def groups_of(a, b):
    both = sorted({e for _, e in a} & {e for _, e in b})
    place = {e: k for k, e in enumerate(both)}
    sides = []
    for side in (a, b):
        held, k = [[] for _ in both], 0
        for i, e in side:
            held[k].append(str(i))
            k = place.get(e, k - 1) + 1
        sides.append(held)
    return [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]


def brute(texts):
    cut = [tokens(t) for t in texts]
    linked = [links_of(a, b) for a, b in cut]
    count = Counter(pair for row in linked for pair in set(row))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    for (a, b), row in zip(cut, linked):
        groups = groups_of(a, b)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        yield (len(a), len(b), len(groups), len(row), sum(count[p] == top[p[0]] for p in row), sum(count[p] for p in row), sha)


def test_slots_are_perfect_and_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 20_000))
    shards = 3
    of = align.shard_of(keys, shards)
    built = [align.build(keys[of == s]) for s in range(shards)]
    slots = align.Slots(0, [b[0] for b in built], [b[1] for b in built], shards)
    at = slots(keys)
    assert sorted(at.tolist()) == list(range(len(keys)))
    assert (np.concatenate([b[2] for b in built])[at] == keys).all()
    some = align.Slots(1, [built[1][0]], [built[1][1]], shards)(keys)
    assert (some[of != 1] == -1).all() and sorted(some[of == 1].tolist()) == list(range(int((of == 1).sum())))
    none = align.Slots(0, [[]], [np.zeros(0, np.uint64)], 1)
    assert none(keys).max() == -1
    assert align.build(keys[:0])[0] == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab' .,\n\t1é<|>endoftxE日  ²s-▁́"), max_size=30), max_size=5))
def test_pieces_give_what_whole_texts_give(texts):
    texts = texts + ODD
    known, codes, at, fine = ALIGNER.read(pa.array(texts))
    for text, s, e, f in zip(texts, at, at[1:], fine):
        a, b, codes_of = *tokens(text), codes[s:e]
        assert bool(f) == bool(a)
        if a:
            assert [int(known[c][codes_of].sum()) for c in ("n_a", "n_b", "n_links")] == [len(a), len(b), len(links_of(a, b))]
            assert ";".join(known["groups"][c] for c in codes_of) == ";".join(groups_of(a, b))
            starts = np.cumsum(known["n_links"]) - known["n_links"]
            links = [int(x) for c in codes_of for x in known["links"][starts[c] : starts[c] + known["n_links"][c]]]
            assert links == [x << 20 | y for x, y in links_of(a, b)]


@pytest.mark.parametrize("shard_keys, at_once", [(1 << 16, 64), (50, 7)])
def test_whole_table(spark, shard_keys, at_once):
    texts = [r[1] for r in edge_rows()] + ODD + ODD[:3]
    rows = [(k % 20 if k else None, t, 1, 2) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_a int, pair int").repartition(3)
    got = align.align(docs, A, B, shard_keys=shard_keys, at_once=at_once)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(r[0], *w) for r, w in zip(rows, brute(texts))]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_edges(spark):
    assert align.align(edges(spark), A, B).count() == len(edge_rows())
    assert align.align(empty(spark), A, B).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: w for r, w in zip(docs, brute([r["text"] for r in docs]))}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op11_alignment"](spark, SF).collect()} == want
