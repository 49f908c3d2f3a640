"""The registry, and a sample of its queries against their SQL twins on the smallest tables."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidegrid import catalog

SF = "/root/testdata/sf0.001"
TABLES = "nation customer orders lineitem events".split()
SAMPLE = [
    "q01_event_grid",
    "p02_event_time_chain",
    "p09_spread_duplicate_times",
    "j05_asof_with_tolerance",
    "j07_overlapping_batches",
    "a15_anomaly_counts_bulk",
    "w10_fill_chain",
    "w13_segment_rows",
    "w15_repair_placeholders",
    "w16_sliding_windows",
    "v01_placeholder_score_bulk",
    "v08_validation_report",
    "q03_unified_sequences",
    "s14_decode_history_log",
    "t7_carry_state",
]


def test_every_twin_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_every_operator_family_is_registered():
    found = {re.match(r"([a-z])0*(\d+)", name).groups() for name in catalog.queries()}
    wanted = {"p": 36, "j": 12, "a": 28, "w": 26, "n": 4, "l": 4, "u": 4, "v": 19, "q": 15, "d": 3, "s": 17, "t": 8}
    for family, count in wanted.items():
        assert {n for f, n in found if f == family} >= {str(i) for i in range(1, count + 1)}, family


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_twin(spark, duck, name):
    mine = entry_point.queries()[name](spark, SF).toArrow()
    duck.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {entry_point.oracle_sql()[name]}")
    duck.register("mine", mine)
    cols = ", ".join(f'"{c}"' for c in sorted(mine.column_names))
    assert duck.execute("SELECT count(*) FROM theirs").fetchall()[0][0] == mine.num_rows
    for a, b in (("mine", "theirs"), ("theirs", "mine")):
        assert duck.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b}").fetchall() == []
