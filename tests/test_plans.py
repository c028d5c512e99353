"""Plan-shape regressions: the properties the scale design depends on."""
import os

from barkeep.operators.actions import normalise_actions
from barkeep.operators.checks import run_checks
from barkeep.plans.board import board
from barkeep.sources import driver as D
from barkeep.sources.silver import load_bars, write_silver

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_blocks(df) -> list:
    """The formatted plan's 'Scan parquet' detail blocks."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    import re
    return re.findall(r"^\(\d+\) Scan parquet.*?(?=\n\n|\Z)", buf.getvalue(), re.M | re.S)


def _silver(spark, scratch):
    root = os.path.join(scratch, "silver")
    for iv in ("1m", "5m"):
        write_silver(D.bars(spark, SF, iv), root, iv)
    return root


def test_board_plan_stays_small(spark, scratch):
    root = _silver(spark, scratch)
    b1, b5 = load_bars(spark, root, "1m"), load_bars(spark, root, "5m")
    store = normalise_actions(D.weekly_feed(spark, SF))
    df = board(b1, b5, store, 7, upto="2024-01-31")
    plan = _plan(df)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # bars are read once per grain (the first version re-derived them in
    # every branch: 55 scans); the day table's scans read `symbol` only
    blocks = _scan_blocks(df)
    bars = [b for b in blocks if "o:double" in b]
    assert len(bars) == 2
    # each bar scan is pruned to the board's date range, then by the day table
    assert all("(date#" in b and "2024-01-07" in b and "dynamicpruning" in b for b in bars)
    assert all("ReadSchema: struct<symbol:string>" in b
               for b in blocks if "o:double" not in b and "interval" in b)


def test_gates_scan_silver_once(spark, scratch):
    root = _silver(spark, scratch)
    plan = _plan(run_checks(load_bars(spark, root, "1m"), "1m", as_of="2024-02-04"))
    assert plan.count("FileScan parquet") == 1


def test_point_read_prunes_and_pushes(spark, scratch):
    root = _silver(spark, scratch)
    plan = _plan(load_bars(spark, root, "5m", symbol="view", since="2024-01-10", upto="2024-01-10"))
    assert "PartitionFilters: [isnotnull(interval" in plan
    assert "EqualTo(symbol,VIEW)" in plan
    assert "ReadSchema: struct<symbol:string,ts:bigint,o:double,h:double,l:double,c:double,v:bigint>" in plan


def test_newest_wins_is_a_hash_aggregate(spark, make_bars):
    from barkeep.operators.merge import merge_bars
    b = make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 5)])
    plan = merge_bars(b, b)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


def test_action_factors_frame_runs(spark, make_bars):
    from barkeep.operators.actions import action_factors
    from barkeep.schema import ACTION
    b = make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 5)]).select("symbol", "date")
    plan = action_factors(b, spark.createDataFrame([], ACTION), "2026-08-20")._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing" not in plan.lower()


def test_archive_stats_does_not_expand(spark, make_bars):
    from barkeep.sources.silver import archive_stats
    b = make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 5)], "1m")
    assert "Expand" not in archive_stats(b)._jdf.queryExecution().executedPlan().toString()


def test_fold_keeps_grains_apart(spark, make_bars):
    from barkeep.operators.candles import fold_bars
    rows = [("A", "2026-08-18", "10:%02d" % m, 1, 1, 1, 1, 1) for m in range(0, 20, 5)]
    two = make_bars(rows, "1m").unionByName(make_bars(rows, "5m"))
    got = sorted((r.interval, r.v) for r in fold_bars(two, 2).collect())
    assert got == [("1m", 2), ("1m", 2), ("5m", 2), ("5m", 2)]


def test_board_ends_at_the_newest_date_of_both_grains(spark, make_bars):
    from barkeep.plans.board import board
    from barkeep.schema import ACTION
    five = make_bars([("A", "2026-08-18", "10:%02d" % m, 1, 1, 1, 1, 1) for m in range(0, 30, 5)])
    out = board(make_bars([]), five, spark.createDataFrame([], ACTION), 7)
    assert out.count() == 6


def test_scratch_needs_a_shared_folder(spark):
    import pytest
    from barkeep import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
