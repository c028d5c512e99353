"""SparkSession helpers: one builder for tests / bench, and the shared
scratch folder the cluster names in `spark.checkpoint.dir`."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession

# Settings the library relies on. AQE re-plans joins from runtime sizes
# (its broadcast conversion is a size check with a sort-merge fallback);
# dynamic partition overwrite replaces only the dates a merge touched.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}



def build_session(master: str | None = None, app: str = "barkeep",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with the library's settings. On a cluster, pass no master
    and let spark-submit decide; locally, `local[N]`."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the one already set, else the one in
    `spark.checkpoint.dir`. A fresh temporary folder is made only for a
    `local[..]` master, where driver and tasks are one process on one disk;
    any other master without a named folder is an error."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        # Spark appends a folder of its own to the one that was set.
        return d.rstrip("/").rsplit("/", 1)[0]
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        d = tempfile.mkdtemp(prefix="barkeep-")
    sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for staged writes
    that must survive an executor loss."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "%s/%s-%s" % (base, name, uuid.uuid4().hex)


def observed(seen: Observation) -> dict:
    """The metrics of an observation; empty where the plan was found to have
    no rows before it ran, so that nothing was observed."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, "%s.parquet" % name)
