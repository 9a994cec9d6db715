"""Registered queries against their SQL at the smallest scale."""

from pathlib import Path

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
# a cross-section; `python tests/oracle.py <folder>` runs all of them
QUICK = ["char_vocab", "encode_split", "speeches", "task_b_examples", "capped_history", "stream_history", "turn_replies",
         "registry_merge", "resolve_refs", "extract_fields", "land_responses", "elapsed_recovery", "step_log_ema"]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.mark.parametrize("name", QUICK)
def test_query(spark, name):
    ok, note = compare(queries()[name](spark, FOLDER), connect(FOLDER), oracle_sql()[name])
    assert ok, note


def test_entry(spark):
    assert entry(spark).columns == ["doc_id", "speech_no", "speaker", "num_lines", "speech_text"]


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())
