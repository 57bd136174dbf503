"""Every registered query equals its SQL, plain and with every key cut."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .check_queries import compare, database

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
ON_STREAMS = {"checkpoint_resume", "sql_event_time", "table_event_time", "proc_tumble", "proc_slide", "proc_session"}
BATCH = [n for n in queries() if not n.startswith("stream_") and n not in ON_STREAMS]
STREAMS = [n for n in queries() if n not in BATCH]
ORDERED = [n for n in BATCH if n.startswith(("cep_", "over_", "count_", "running_", "session_", "top3_r", "late_", "allowed_"))
           or n in ("event_session", "uv_running", "control_asof", "reconcile_join", "retract_changelog", "jump_alarm",
                    "rising_alarm", "rolling_max", "reduce_running", "first_seen_per_value")]


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", BATCH + STREAMS)
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


@pytest.mark.parametrize("name", ORDERED)
def test_matches_sql_when_cut(spark, con, small_tasks, name):
    assert compare(spark, con, SF, name) is None


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    result = entry(spark)
    assert result.columns == ["user_id", "tag", "first_event_id", "last_event_id"]
    assert result.count() > 0
