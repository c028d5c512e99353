"""Incremental bronze -> silver with Structured Streaming.

New landed files are picked up as a file stream over the bronze folder; each
micro-batch is inflated once into a table in the shared folder, parsed and
merged into silver with the same newest-wins merge as a batch rebuild. The
merge is idempotent, so a replayed micro-batch (after a driver or executor
loss) changes nothing; late data is always accepted - no watermark, no state
store. Bars keep the fetch they came from in silver, so the answer does not
depend on how the files fall into micro-batches.

Dead letters never stop the query: a damaged file goes whole to the
quarantine table, as do responses without a symbol, a grain this archive
knows or a fetch date, those without a chart, and single wrong values - all
named before anything of their micro-batch is merged. Progress is
checkpointed under the cluster's shared `spark.checkpoint.dir`; a checkpoint
of the former stream of parsed lines cannot be continued.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barkeep.operators.parse import bars_of, read_responses
from barkeep.session import ensure_checkpoint_dir, scratch_path
from barkeep.sources.bronze import QUARANTINE, bronze_stream, damaged, keep_quarantine, staged
from barkeep.sources.silver import merge_into_silver


def stream_merge(spark: SparkSession, bronze_root: str, silver_root: str,
                 name: str = "bronze-to-silver", checkpoint: str | None = None,
                 available_now: bool = True,
                 max_files_per_trigger: int | None = None,
                 summary_root: str | None = None,
                 quarantine_root: str | None = None) -> StreamingQuery:
    """Start the incremental merge. `available_now` processes everything
    landed so far in bounded micro-batches, then stops (a nightly run);
    otherwise it keeps polling every minute. With `summary_root`, the
    gates' kept summary is refreshed for each batch's dates. What cannot
    be used goes to `quarantine_root` (`_quarantine` under silver)."""
    aside = quarantine_root or os.path.join(silver_root, QUARANTINE)
    ckpt = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "stream", name)

    def merge_batch(files: DataFrame, batch_id: int) -> None:
        rows = staged(files, scratch_path(spark, "stream-batch"))
        whole = rows.where("damage is null").drop("damage")
        keep_quarantine(whole, aside, damaged(rows))
        r = read_responses(whole).where("_fault is null")
        # every grain of the batch, a few values
        for (iv,) in sorted(r.select("interval").distinct().collect()):
            merge_into_silver(bars_of(r.where(r["interval"] == iv)), silver_root, iv, summary_root=summary_root)

    w = (bronze_stream(spark, bronze_root, max_files_per_trigger)
         .writeStream.queryName(name).option("checkpointLocation", ckpt)
         .foreachBatch(merge_batch))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
