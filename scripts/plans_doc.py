"""Write PLANS.md: formatted physical plans of the main operators over a
silver archive built from the sf tables (scratch folder under the shared
checkpoint dir).

    python scripts/plans_doc.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _tree_and_scans(text: str) -> str:
    tree, _, detail = text.partition("\n\n\n")
    scans = []
    for block in detail.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.splitlines()[0]:
            keep = [ln for ln in block.splitlines()
                    if ln.startswith("(") or ln.startswith(("Output", "PartitionFilters", "PushedFilters",
                                                            "ReadSchema", "DataFilters"))]
            scans.append("\n".join(keep))
    text = tree.strip() + ("\n\n" + "\n\n".join(scans) if scans else "")
    return re.sub(r"file:[^\s,\]]*/", "…/", text)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from barkeep.session import build_session, scratch_path
    spark = build_session("local[8]", shuffle_partitions=8)
    from pyspark.sql import functions as F

    from barkeep.operators.actions import normalise_actions
    from barkeep.operators.checks import run_checks
    from barkeep.operators.merge import merge_bars
    from barkeep.plans.board import board
    from barkeep.sources import driver as D
    from barkeep.sources.silver import load_bars, write_silver

    root = scratch_path(spark, "plans-silver")
    for iv in ("1m", "5m"):
        write_silver(D.bars(spark, sf, iv), root, iv)
    b1, b5 = load_bars(spark, root, "1m"), load_bars(spark, root, "5m")
    store = normalise_actions(D.weekly_feed(spark, sf))
    newest = b1.agg(F.max("date")).first()[0]
    sections = [
        ("Point read: one symbol, a date range (S4, P6, P7)",
         "Dates prune directories (PartitionFilters); the symbol reaches the parquet reader "
         "(PushedFilters) where the (symbol, ts) sort lets min/max statistics skip row groups.",
         load_bars(spark, root, "1m", symbol="view", since="2024-01-08", upto="2024-01-14")),
        ("Board, 7 sessions, every symbol (C1)",
         "One aggregation to the day table; per-symbol windows run on it (one row per session "
         "and grain); action factors by an as-of window; bars joined back once on "
         "(symbol, date, grain) and folded per (symbol, date).",
         board(b1, b5, store, 7, upto=newest)),
        ("All eight gates (C2)",
         "One scan: per-(symbol, date) summary, per-date fold, one verdict row, unpivoted.",
         run_checks(b1, "1m", as_of="2024-02-04")),
        ("Newest-wins merge of one re-fetched day (G1)",
         "An aggregate over (symbol, ts, date) with a partial step on each side of the shuffle: "
         "copies of one key are combined before they move.",
         merge_bars(b1.where(F.col("date") == F.lit(newest)).withColumn("fetched", F.date_add("date", 1)),
                    b1.where(F.col("date") == F.lit(newest)))),
    ]
    print("# Physical plans\n")
    print("Generated by `scripts/plans_doc.py %s` over a silver archive written by "
          "`write_silver` (AQE on; the final plan may broadcast small sides).\n" % sf)
    for title, note, df in sections:
        df.write.format("noop").mode("overwrite").save()
        print("## %s\n\n%s\n\n```\n%s\n```\n" % (title, note, _tree_and_scans(_formatted(df))))
    spark.stop()


if __name__ == "__main__":
    main()
