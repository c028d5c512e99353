"""Corporate-action store and feed I/O (S9, S10, S11, S12 input side).

The store is a parquet table of `schema.ACTION` rows. A version is a folder of
data (`data-<uuid>`) and a small file `version-<n>` that names it; the highest
named one is current. A save writes its data first and then claims the next
number by creating that file, which only one of several writers can do; one
that loses merges again with what won and tries the next number. So a reader
never sees a half-written store, a failed save leaves the old one, and no
concurrent save drops another's additions. All but the last KEEP versions are
removed after a commit.
"""

from __future__ import annotations

import os
import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkeep.operators.actions import merge_actions, new_actions
from barkeep.schema import ACTION, ACTION_FEED


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


#: Versions left for readers that opened them before a commit.
KEEP = 3
#: Seconds a claimed number may wait for its name before it counts as given up.
GIVEN_UP = 10


def _claims(spark: SparkSession, store: str) -> list[int]:
    """Claimed version numbers, newest first."""
    fs, p = _fs(spark, store)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted((int(n[8:]) for n in names if re.fullmatch(r"version-\d+", n)), reverse=True)


def _claim_path(store: str, n: int) -> str:
    return os.path.join(store, "version-%012d" % n)


def _data_of(spark: SparkSession, store: str, n: int) -> str | None:
    """The data folder a version names; None when its writer was cut off
    between creating and filling the file, more than GIVEN_UP seconds ago."""
    fs, p = _fs(spark, _claim_path(store, n))
    while fs.exists(p):                       # a later commit may remove it
        st = fs.getFileStatus(p)
        if st.getLen():
            stream = fs.open(p)
            try:
                return os.path.join(store, bytes(stream.readNBytes(st.getLen())).decode())
            finally:
                stream.close()
        if time.time() - st.getModificationTime() / 1000 > GIVEN_UP:
            return None
        time.sleep(0.1)
    return None


def _current(spark: SparkSession, store: str) -> tuple[int, str | None]:
    """(highest claimed number, data folder of the newest named version). A
    store without numbers is read as its newest committed `v-` folder."""
    claims = _claims(spark, store)
    for n in claims:
        found = _data_of(spark, store, n)
        if found:
            return claims[0], found
    fs, p = _fs(spark, store)
    old = sorted((st.getPath().getName() for st in fs.listStatus(p)), reverse=True) if fs.exists(p) else []
    for name in old:
        if name.startswith("v-") and fs.exists(_fs(spark, os.path.join(store, name, "_SUCCESS"))[1]):
            return claims[0] if claims else 0, os.path.join(store, name)
    return claims[0] if claims else 0, None


def _claim(spark: SparkSession, store: str, n: int, data: str) -> bool:
    """Makes `data` version `n`, unless another writer has that number."""
    fs, p = _fs(spark, _claim_path(store, n))
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    try:
        out.write(bytearray(data.encode()))
    finally:
        out.close()
    return True


def _sweep(spark: SparkSession, store: str, n: int) -> None:
    """Removes versions up to n - KEEP, their data with them."""
    fs, _ = _fs(spark, store)
    for old in _claims(spark, store):
        if old <= n - KEEP:
            data = _data_of(spark, store, old)
            fs.delete(_fs(spark, _claim_path(store, old))[1], False)
            if data:
                fs.delete(_fs(spark, data)[1], True)


def _table(spark: SparkSession, data: str | None) -> DataFrame:
    return spark.read.schema(ACTION).parquet(data) if data else spark.createDataFrame([], ACTION)


def read_actions(spark: SparkSession, store: str) -> DataFrame:
    """The store; a missing store is an empty table, not an error."""
    return _table(spark, _current(spark, store)[1])


def save_actions(spark: SparkSession, incoming: DataFrame, store: str, attempts: int = 20) -> tuple[int, int]:
    """Merge `incoming` into the store; returns (total, added),
    `added` counting incoming rows whose key was not held (J2).

    Compare and swap: the merge starts from version n, is written whole, and
    becomes version n + 1 only if no other writer claimed that number; else it
    is removed and made again from what is now current."""
    for _ in range(attempts):
        n, data = _current(spark, store)
        existing = _table(spark, data)
        mine = "data-" + uuid.uuid4().hex
        target = os.path.join(store, mine)
        merge_actions(incoming, existing).write.mode("error").parquet(target)
        if _claim(spark, store, n + 1, mine):
            added = new_actions(incoming, existing).count()
            total = spark.read.schema(ACTION).parquet(target).count()
            _sweep(spark, store, n + 1)
            return total, added
        fs, p = _fs(spark, target)
        fs.delete(p, True)
    raise RuntimeError("%s: %d saves in a row came second" % (store, attempts))


def read_action_feed(spark: SparkSession, path: str) -> DataFrame:
    """S12 input: the exchange's JSON array of actions (one array per file,
    a day's feed). Field names differ by vintage and only by letter case
    (exDate / exdate), so each element is parsed as a string map and the
    keys are looked up exactly - independent of spark.sql.caseSensitive."""
    raw = spark.read.option("wholetext", "true").text(path)
    rows = raw.select(F.explode(F.from_json("value", "array<map<string,string>>")).alias("r"))
    return rows.select(*[F.col("r")[f.name].alias(f.name) for f in ACTION_FEED.fields])


def listed_symbols(symbol_list: DataFrame, series=("EQ",), limit: int | None = None) -> DataFrame:
    """The symbol master list -> distinct trimmed symbols whose
    series is in `series` (empty = every series). Header names are matched
    after stripping spaces, so both ' SERIES' vintages read the same."""
    df = symbol_list.toDF(*[c.strip() for c in symbol_list.columns])
    sym = F.trim(F.coalesce(F.col("SYMBOL"), F.lit("")))
    ser = F.trim(F.coalesce(F.col("SERIES"), F.lit("")))
    out = df.select(sym.alias("symbol"), ser.alias("series")).where(F.col("symbol") != "")
    if series:
        out = out.where(F.col("series").isin(list(series)))
    out = out.select("symbol").distinct()
    if limit:
        out = out.orderBy("symbol").limit(limit)
    return out


def read_symbol_list(spark: SparkSession, path: str) -> DataFrame:
    """S11 input: the master CSV (header row, every column as text)."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


def explicit_symbols(spark: SparkSession, text: str) -> DataFrame:
    """A comma-separated list -> trimmed, upper-cased symbols."""
    syms = [s.strip().upper() for s in text.split(",") if s.strip()]
    return spark.createDataFrame([(s,) for s in syms], "symbol string")
