import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, rules, templates
from tests.check_queries import compare, database

from .cases import MORE, SF, edge_rows, edges, empty, prose, words


@pytest.mark.parametrize("name", ["op2_mixing", "op5_quality_rules"])
def test_matches_sql(spark, name):
    assert compare(spark, database(SF), SF, name) is None
    assert compare(spark, database(MORE), MORE, name) is None


def test_mix_of_edges(spark):
    rows = mixing.mix(edges(spark)).collect()
    assert len(rows) == len(edge_rows())
    assert sorted(r.size for r in rows) == sorted(len(words(r[1])) for r in edge_rows())
    total, longest = {}, max(r.size for r in rows)
    for r in rows:
        assert r.taken == r.size * len(r.positions) <= 2 * r.size and r.positions == sorted(r.positions)
        assert all(0 <= p <= 1 for p in r.positions)
        assert r.target <= 2 * r.source_size
        total.setdefault((r.source, r.target), []).append(r.taken)
    assert all(abs(sum(t) - target) <= longest / 2 + 1 for (_, target), t in total.items())
    assert {r.source for r in rows} == {"a", "b", "c", "", None}
    assert mixing.mix(empty(spark)).collect() == []
    assert mixing.by_position(mixing.mix(edges(spark))).count() == len(rows)


@pytest.mark.parametrize("sizes", [[5, 5, 5], [100, 1, 1, 1], [0, 7, 9], [0, 0], [1, 1000, 10, 10, 500, 3]])
def test_targets_fill_by_weight_up_to_twice_the_size(spark, sizes):
    names = [None if k == len(sizes) - 1 else chr(97 + k) for k in range(len(sizes))]
    rows = mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size bigint")).collect()
    got = {r.source: r.target for r in rows}
    weights = [(3, 1, 2)[k % 3] for k in range(len(sizes))]
    # Share out, stop at the limit, share the excess again.
    want, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = 1.5 * sum(sizes)
    while True:
        w = sum(weights[k] for k in open_)
        over = [k for k in open_ if left * weights[k] / w > 2 * sizes[k] + 1e-9] if w else []
        if not over:
            break
        for k in over:
            want[k] = 2.0 * sizes[k]
        open_ -= set(over)
        left = 1.5 * sum(sizes) - sum(want[k] for k in set(range(len(sizes))) - open_)
    for k in open_:
        want[k] = left * weights[k] / sum(weights[j] for j in open_)
    assert [got[n] for n in names] == pytest.approx(want)


def test_positions_follow_the_schedule(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    order = mixing.in_training_order(mixing.mix(docs))
    shares = {}
    for r in order.select("source", "position").collect():
        shares.setdefault(r.source, []).append(r.position)
    for kind, rates in zip(sorted(shares), mixing.RATES):
        early = sum(p < 0.5 for p in shares[kind]) / len(shares[kind])
        want = {(1.5, 1.0, 0.5): 0.625, (0.5, 1.0, 1.5): 0.375, (1.0, 1.0): 0.5}[rates]
        assert early == pytest.approx(want, abs=0.01)
    parts = order.select("position", F.spark_partition_id().alias("p")).collect()
    assert [r.position for r in parts] == sorted(r.position for r in parts)


def test_mix_repeats_itself(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, two = mixing.mix(docs), mixing.mix(docs.repartition(13))
    columns = ["doc_id", "taken", "positions"]
    assert one.select(columns).exceptAll(two.select(columns)).count() == 0


def base(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    runs = {}
    for k in range(len(w) - 2):
        runs.setdefault(tuple(w[k : k + 3]), []).append(k)
    covered = {k + j for ks in runs.values() if len(ks) > 1 for k in ks for j in range(3)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in rules.SYMBOLS), len(lines) - len(set(lines)), len(covered))


def test_rules_on_edges(spark):
    rows = rules.check(edges(spark)).collect()
    got = sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((d or 0, *base(t)) for d, t, *_ in edge_rows())
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert rules.check(empty(spark)).collect() == []


def test_common_lines_count_by_text_and_host(spark):
    line = "Home   Contact 2024 Terms and a few more words to make it long enough to matter " + prose(24, 77, 24)
    other = line.lower().replace("2024", "7")
    rows = [(k, "\n".join([prose(60, k), line if k % 2 else other] + [f"unique {chr(97 + k)}"]), "h1") for k in range(12)]
    rows += [(100 + k, prose(30, 500) + "\n" + line, "h1") for k in range(1)]  # most of it is the line
    rows += [(200 + k, prose(60, 300) + "\n" + line, "h2") for k in range(40)]  # copies are one text
    got = {r.doc_id: r for r in rules.check(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    n = len(words(line))
    assert all(got[k].kept and got[k].n_words - got[k].n_left_words == n for k in range(12))
    assert not got[100].kept and not got[100].base_failed and got[100].n_left_words == 30
    assert all(got[200 + k].kept and got[200 + k].n_left_words == got[200 + k].n_words for k in range(40))


def templated(k):
    return f"Page {k} of our site was last changed on day {k * 7} by someone"


def test_recurring_templates_go_and_their_variable_fields_too(spark):
    rows = [(k, "\n".join([prose(40, k), templated(k), "Subscribe to the weekly letter here", prose(20, 900 + k), "short line"])) for k in range(12)]
    rows += [(50, prose(40, 700) + "\nSubscribe to a daily list here now"), (51, None), (52, ""), (None, rows[0][1]), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("n_lines", "c1", "leaf", "number", "_drop2")})
    out = templates.drop_lines(docs).collect()
    got = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    for k in range(12):
        assert got[k].text == "\n".join([prose(40, k), prose(20, 900 + k), "short line"]) and got[k].n_dropped_lines == 2
    assert got[None].text == got[0].text
    assert got[50].text == rows[12][1] and got[50].n_dropped_lines == 0
    assert got[51].text is None and (got[51].n_lines, got[51].n_dropped_lines) == (0, 0) and got[52].text == ""


def test_copies_are_left_to_the_search_for_copies(spark):
    rows = [(k, prose(100, 5) + f"\nits own ending number {'abcdefghijklmnopqrstuvwxyz'[k]} here") for k in range(20)]
    out = templates.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.text for r in out} == dict(rows)


def test_boilerplate_goes_whatever_its_share_and_what_copies_share_stays(spark):
    passage, body = prose(60, 8), prose(200, 9, 200)
    rows = [(k, prose(20, 30 + k, 20) + "\n" + passage) for k in range(12)]  # most of each is the passage
    rows += [(100 + k, body + " more" * k + "\nthe last line of this one page") for k in range(12)]  # copies with one ending
    out = templates.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = {r.doc_id: r.text for r in out}
    assert all(got[k] == prose(20, 30 + k, 20) for k in range(12))
    assert all(got[k] == t for k, t in rows[12:])


def test_short_boilerplate_goes(spark):
    rows = [(k, "\n".join([prose(40, k, 40), "All rights reserved.", "Home", f"Page {k} of {k + 9}", f"by me {chr(97 + k)}"])) for k in range(24)]
    rows += [(100, prose(40, 700, 40) + "\nAll rights waived.\nHome again"), (101, "Home\n\nAll  rights reserved.")]
    out = templates.drop_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = {r.doc_id: (r.text, r.n_dropped_lines) for r in out}
    assert all(got[k] == (prose(40, k, 40) + f"\nby me {chr(97 + k)}", 3) for k in range(24))
    assert got[100] == (rows[24][1], 0) and got[101] == ("", 2)


def test_templates_on_edges(spark):
    out = templates.drop_lines(edges(spark)).select("doc_id", "text").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in out) == sorted((r[0] or 0, r[1] or "") for r in edge_rows())
    assert templates.drop_lines(empty(spark)).collect() == []


def plain_line(line):
    return re.sub("[0-9]+", "0", re.sub(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z", "", line).translate({k: k + 32 for k in range(65, 91)}))


def test_frequent_lines_are_removed(spark):
    pick = random.Random(5)
    rows = []
    for k in range(90):
        own = [f"own line {k} {j} word{'x' * k}" for j in range(pick.randint(0, 3))]
        shared = pick.sample(["Menu | Home", "  menu | home ", "page 12 of 30", "Page 7 of 9", "", " \t", "rare a", f"rare {'abc'[k % 3] * 3}"], 4)
        rows.append((k, "\n".join(pick.sample(own + shared, len(own + shared))), pick.choice(["h1", "h2", None])))
    rows += [(100, None, "h1"), (101, "", "h1"), (102, "menu | home", "h1"), (103, "menu | home", "h3"), rows[0], rows[0]]
    hold = {}
    for _, t, h in rows:
        for line in (t or "").split("\n"):
            if words(line):
                hold.setdefault((h, plain_line(line)), set()).add(t)
    want = [(i, t if t is None else "\n".join(x for x in t.split("\n") if len(hold.get((h, plain_line(x)), ())) <= 6), h, 1) for i, t, h in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3).withColumn("_row", F.lit(1))
    got = rules.remove_frequent_lines(docs, max_docs=6)
    assert got.columns == docs.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    judged = {r["doc_id"]: r["n_left_words"] for r in rules.check(docs, max_docs=6).collect()}
    assert judged == {i: len(words(t)) for i, t, _, _ in want}


def test_rules_judge_by_the_text_without_frequent_lines(spark):
    """The verdict comes from the text the operator returns, places of its lines included."""
    rows = [(k, f"own {chr(97 + k)} words\nMenu {k}\n\n menu 7\nlast {chr(97 + k)}", "h") for k in range(4)]
    rows += [(10, "menu 1", "h"), (11, "menu 1", None), (12, None, "h"), (13, "", "h"), rows[0]]
    got = rules.check(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), max_docs=3, least_words=1).collect()
    clean = {10: "", 11: "menu 1", 12: None, 13: ""} | {k: f"own {chr(97 + k)} words\n\nlast {chr(97 + k)}" for k in range(4)}
    assert len(got) == len(rows)
    for r in got:
        assert r.clean_text == clean[r.doc_id] and r.n_left_words == len(words(r.clean_text))
        assert r.kept == (not r.base_failed and 2 * r.n_left_words >= r.n_words)


def test_frequent_lines_of_odd_tables(spark):
    some = edges(spark)
    assert sorted(map(str, rules.remove_frequent_lines(some).collect())) == sorted(map(str, some.collect()))
    assert rules.remove_frequent_lines(empty(spark)).collect() == []


@pytest.mark.parametrize("texts", [["\n\na 1b c\n\n x9 \n", None, "", "\n", "a", "5", "a\n5 b\nc", "x\n" * 3, " \n 7"], [None], ["\n"], []])
def test_lines_of_a_batch(texts):
    """Row, number in the text and tokens of each line, and which tokens are the first of their text at leaf and place."""
    got = templates._Lines(pa.array(texts, pa.string()), 3)
    lines = [(r, k, line.split()) for r, t in enumerate(texts) for k, line in enumerate((t or "").split("\n")) if line.split()]
    assert list(zip(got.row.tolist(), got.number.tolist(), got.size.tolist())) == [(r, k, len(w)) for r, k, w in lines]
    words = [w for _, _, line in lines for w in line]
    assert [t == 0 for t in got.tokens.tolist()] == [bool(re.search("[0-9]", w)) for w in words]
    new = got.new(np.arange(len(lines)), np.arange(len(words)))
    spots = [(r, leaf, place) for (r, _, w), leaf in zip(lines, got.leaf.tolist()) for place in range(len(w))]
    spots = [(*s, t) for s, t in zip(spots, got.tokens.tolist())]
    assert new.tolist() == [s not in spots[:k] for k, s in enumerate(spots)]
