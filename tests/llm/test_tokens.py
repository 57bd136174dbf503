import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import packing, token_files
from millrace.llm.tokens import Encoder, tokenizer_path
from millrace.session import scratch_path

from .cases import SF, edge_rows, edges, empty

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path()
WHOLE = tokenizers.Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH, 3)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


ODD = ["", None, " ", "\n", "  a  b \n c ", "a <|endoftext|> b  <|endoftext|>", "<|endoftext|>", "it's    x  y'll 'store it'd", "\x1c a \x1f b",
       " lead", "trail ", "a\n b", "tab\t x", "日本 語 ﬁ ǅ", "x  y", "a  b", "a\n\n\nb", "12ab 3²4", "É é ß … — “q”", "a\r\nb \r c", "x" * 5000]


def test_pieces_give_the_ids_of_the_whole():
    found, at = ENCODER(pa.array(ODD))
    assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == [ids(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab' .,\n\t1é<|>endoftxE日  ²s-"), max_size=30), max_size=6))
def test_any_text(texts):
    found, at = ENCODER(pa.array(texts, pa.string()))
    assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == [ids(t) for t in texts]


def test_sliced_column():
    column = pa.array(["x", *ODD, "y"]).slice(1, len(ODD))
    found, at = ENCODER(column)
    assert [found[a:b].tolist() for a, b in zip(at, at[1:])] == [ids(t) for t in ODD]


def written(spark, docs):
    path = scratch_path(spark, "test-files")
    token_files.write(docs, path, PATH, end_id=0)
    return token_files.read(spark, path)


def test_files_round_trip(spark):
    files = written(spark, edges(spark))
    rows = files.orderBy("part", "ids_before").collect()
    want = sorted(((d, t) for d, t, *_ in edge_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [d for d, _ in want]
    assert sorted((r.doc_id or 0, tuple(r.ids)) for r in rows) == sorted((d or 0, (*ids(t), 0)) for d, t in want)
    assert all(r.n_ids == len(r.ids) for r in rows)
    got = {(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.digest(files).collect()}
    start = 0
    for place in sorted(got, key=lambda r: r[0]):
        assert place[0] == start
        start += place[2]
    assert len(got) == len(want) and sorted(g[3] for g in got) == sorted(crc([*ids(t), 0]) for _, t in want)


def test_files_of_an_empty_table(spark):
    files = written(spark, empty(spark))
    assert files.collect() == [] and token_files.digest(files).collect() == []


def test_files_are_dictionary_and_delta_encoded_with_page_indexes(spark):
    import glob

    import pyarrow.parquet as pq

    path = scratch_path(spark, "test-files")
    token_files.write(spark.read.parquet(f"{SF}/documents.parquet"), path, PATH)
    group = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata.row_group(0)
    by_name = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "RLE_DICTIONARY" in by_name["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in by_name["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in by_name.values() if not c.path_in_schema.startswith("ids."))


def check_packing(rows, texts, capacity):
    """Every id of every text is placed exactly once, gapless, within the capacity."""
    space, pieces = {}, {}
    for r in rows:
        assert 0 < r.length <= capacity
        space.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for spans in space.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in texts:
        want, got = [*ids(text), 2], sorted(pieces.pop(doc), key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(got):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == crc(want[at : at + r.length])
            at += r.length
        assert at == len(want) and (len(got) == 1 or all(r.length == capacity for r in got[1:]))
    assert not pieces
    return len(space)


def test_packing_places_everything(spark):
    once = [r for k, r in enumerate(edge_rows()) if r[0] is not None and r not in edge_rows()[:k]]
    docs = spark.createDataFrame(once, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    check_packing(packing.pack(docs, PATH).collect(), [(r[0], r[1]) for r in once], 1024)


def test_packing_of_edges_and_empty_tables(spark):
    rows = packing.pack(edges(spark), PATH).collect()
    assert sum(r.length for r in rows) == sum(len(ids(r[1])) + 1 for r in edge_rows())
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(empty(spark), PATH).collect() == []


def test_packing_is_tight(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    used = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 1024)
    assert used <= -(-sum(r.length for r in rows) // 1024) * 1.03 + 1


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e"), (3, None)], "doc_id bigint, text string")
    made = packing.sequences(packing.pack(docs, PATH, capacity=6, keep_ids=True)).collect()
    whole = {d: [*ids(t), 2] for d, t in [(1, "a b c"), (2, "d e"), (3, None)]}
    for r in made:
        assert len(r.ids) <= 6
        ends = [*r.offsets[1:], len(r.ids)]
        assert all(r.ids[a:b] == whole[d] for a, b, d in zip(r.offsets, ends, r.doc_ids))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 60), max_size=12), st.integers(40, 60))
def test_fit_uses_each_piece_once(counts, capacity):
    left, used = dict(counts), 0
    for times, lengths in packing.fit(counts, capacity):
        assert times > 0 and 0 < sum(lengths) <= capacity
        used += times
        for n in lengths:
            left[n] -= times
    assert not any(left.values())
    assert used <= 2 * sum(n * c for n, c in counts.items()) / capacity + 1  # all but one are more than half full


def test_two_unpacked_pieces_replace_the_smallest():
    # 60 + 30 leaves 10; 22 + 18 fill the gap of 40 that 30 leaves.
    assert packing.fit({60: 1, 30: 1, 22: 1, 18: 1}, 100)[0] == (1, [60, 22, 18])


def test_packing_does_not_depend_on_batches(spark):
    whole, small = (packing.pack(edges(spark), PATH, batch_bytes=b).select("doc_id", "piece", "start", "length", "ids_crc32") for b in (16 << 20, 20))
    assert sorted(map(str, whole.collect())) == sorted(map(str, small.collect()))


@pytest.mark.parametrize("remember", [0, 5, 400_000])
def test_remembered_pieces_have_the_same_ids(remember):
    kept, asked = Encoder(PATH, 3, remember), []
    pool = kept._pool
    kept._pool = lambda after, first: asked.append(len(after)) or pool(after, first)
    long = "w" * 100
    batches = [["one two two three three", f"x {long} {long} two é é"], ["four two three é", None, f"two two {long}", "three  three\n two"], [], ["five five six six two", "é two"]]
    for texts in batches:
        column = pa.array(texts, pa.string())
        (ids, at), (want, there) = kept(column), Encoder(PATH, 3)(column)
        assert ids.tolist() == want.tolist() and at.tolist() == there.tolist()
        assert len(kept._known) <= remember
    if remember > 5:
        assert asked == [4, 1, 2]  # of the second batch only the long one, of the last five and six
        assert sorted(kept._known.to_pylist()) == ["six", "three", "two", "é"]
