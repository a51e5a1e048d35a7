"""Queries against their SQL in DuckDB, on the smallest test tables."""

import decimal
import numbers
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    """A value as one type for both engines: whole numbers as int, others as float."""
    if pd.isna(x):
        return None
    if isinstance(x, (bool, np.bool_)):
        return bool(x)
    if isinstance(x, (numbers.Number, decimal.Decimal)):
        return int(x) if x == int(x) else float(x)
    return str(x)


def rows(frame, columns):
    return sorted(str(tuple(map(plain, r))) for r in frame[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equal(spark, duck, name):
    want, got = duck.execute(ORACLE[name]).df(), QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got.toPandas(), columns) == rows(want, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_part_gets_a_verdict_and_every_event_is_a_sample(spark):
    from tidemark import queries

    at = f"{os.path.dirname(SF)}/sf0.01"
    n = {t: spark.read.parquet(f"{at}/{t}.parquet").count() for t in ("part", "events")}
    got = QUERIES["match_verdicts"](spark, at).select("segment_id", "reason_code").collect()
    assert len(got) == len({r.segment_id for r in got}) == n["part"] and len({r.reason_code for r in got}) > 2
    track = queries._track(spark, at, 0.2)
    assert track.count() == track.select("video_id", "timestamp").distinct().count() == n["events"]
    hovers = QUERIES["pointer_hovers"](spark, at).collect()
    assert len({r.video_id for r in hovers}) > 20 and len({(r.video_id, r.start_s) for r in hovers}) > 20 * 300


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_joins_have_no_nested_loop(spark, capsys):
    for name in ("interval_overlap_join", "point_in_interval", "nearest_in_radius", "asof_hold"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_retimed_at_the_limits(spark, tmp_path):
    """Shots that lie on a limit: 200 words make t / d = 1.08, 5 words d - t = 0.8 or near it, whatever comes before."""
    n = [200, 7, 200, 13, 5, 200, 40, 200]
    told = pd.DataFrame([(c, t, "user", " ".join(["w"] * n[(c + t) % 8])) for c in range(40) for t in range(8)], columns=["conv_id", "turn", "role", "text"])
    told.to_parquet(f"{tmp_path}/conversations.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet'")
    want, columns = c.execute(ORACLE["retime_segments"]).df(), ["conv_id", "turn", "new_start", "planned", "outcome"]
    assert rows(QUERIES["retime_segments"](spark, str(tmp_path)).toPandas(), columns) == rows(want, columns)
