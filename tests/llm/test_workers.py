"""Queries run where only the driver has the package."""

import os
import subprocess
import sys

import pyarrow as pa
import pytest

from millrace.llm import text
from millrace.session import settle

SCRIPT = """
import sys, tempfile
sys.path.insert(0, sys.argv[1])
from millrace.llm.queries import QUERIES
from millrace.session import build_session
conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": tempfile.mkdtemp()}
spark = build_session("workers", "local[4]", conf)
for name in sys.argv[2:]:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("names", [["op1_language_id", "op9_quality_classifier", "op10_best_fit_packing"],
                                   ["op8_token_files", "op11_alignment", "op12_exact_top_k"]])
def test_workers_cannot_import_the_package(tmp_path, names):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert set(counts) == set(names) and all(int(n) > 0 for n in counts.values()), done.stderr[-2000:]


def test_steps_get_batches_of_bounded_size(spark):
    docs = spark.range(400).selectExpr("id", "repeat('long words ', 10000) as text").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    found = [r["size"] for r in settle(docs.mapInArrow(sizes, "size bigint")).collect()]
    assert sum(found) > 40_000_000 and max(found) < 6 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_large_values_go_with_the_first_task_that_does_not_ask_for_them():
    made = []

    def task(asks):
        if asks:
            text.per_worker("a large value", lambda: made.append(1) or made, large=True)
        list(text.pieces(iter([pa.RecordBatch.from_arrays([pa.array(["x"])], ["text"])]), "text"))

    for asks in (True, True, False, True, False):
        task(asks)
    assert len(made) == 2 and "a large value" not in sys.modules["_millrace_worker"].__dict__
