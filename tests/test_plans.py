"""Plan checks: shuffles, joins and what reaches the scan."""

import os
import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plan(spark, name, capsys):
    queries()[name](spark, SF).explain("formatted")
    return capsys.readouterr().out


ONE_SHUFFLE = ["running_sum", "rolling_max", "top3_running", "retract_changelog", "over_rows", "over_range", "cep_next",
               "cep_followed_by", "cep_followed_by_any", "cep_until", "cep_login_fail", "cep_greedy", "cep_group",
               "count_tumble", "count_slide", "event_session", "event_tumble", "top3_per_key", "max_by_first"]
NO_SHUFFLE = ["map_project", "filter_even", "to_json", "union_all", "connect_comap", "side_output_split", "cep_single",
              "flatmap_words", "scalar_functions"]


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_one_shuffle(spark, capsys, name):
    text = plan(spark, name, capsys)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_no_shuffle(spark, capsys, name):
    assert "Exchange" not in plan(spark, name, capsys)


def test_filter_and_columns_reach_the_scan(spark, capsys):
    text = plan(spark, "pv_count", capsys)
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<event_type:string>" in text


def test_rank_limit_before_the_shuffle(spark, capsys):
    text = plan(spark, "top3_per_key", capsys)
    assert text.index("WindowGroupLimit") < text.index("Exchange")


def test_cut_plan_has_no_window_over_a_whole_key(spark, capsys, small_tasks):
    text = plan(spark, "running_sum", capsys)
    shuffles = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text)
    assert any("user_id" in s and "_slice" in s for s in shuffles)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_sources_without_shuffle_stay_pruned(spark, capsys):
    assert "ReadSchema: struct<event_type:string>" in plan(spark, "pv_count", capsys)
