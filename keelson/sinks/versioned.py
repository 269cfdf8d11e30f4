"""Tables that are replaced while readers use them.

A write goes to a fresh version folder; then one small pointer file is
replaced by an atomic rename.  Readers resolve the pointer first, so they see
the old content or the new one, never a mixture, and a write that dies
half-way leaves the old content as it was.  There is no transaction log: the
pointer names, for each part of the table, the folder that holds it.

A part is the whole table (``replace``), several tables that must change
together (``replace_all``: Silver and Quarantine), or one key bucket
(``merge_buckets``: only the buckets that a load touches are written anew,
the others stay in the folders they are in).

The pointer is read and renamed through the file system of its path, so the
table may lie in any store that Spark writes to and that renames atomically.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_current"
BUCKET = "_key_bucket"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def pointer(spark: SparkSession, root: str) -> dict[str, str]:
    """Part -> folder (relative to ``root``) of the current version; empty
    before the first write."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{POINTER}")
    if not fs.exists(p):
        return {}
    stream = fs.open(p)
    try:
        data = bytes(stream.readAllBytes())
    finally:
        stream.close()
    return json.loads(data.decode())


def write_pointer(spark: SparkSession, root: str, parts: dict[str, str]) -> None:
    """Replace the pointer: written beside it, then renamed over it."""
    root = root.rstrip("/")
    jvm = spark._jvm
    fs, tmp = _fs(spark, f"{root}/{POINTER}-{uuid.uuid4().hex[:12]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(tmp, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), overwrite)


def _fresh() -> str:
    return f"version-{uuid.uuid4().hex[:12]}"


def replace(df: DataFrame, root: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table."""
    replace_all({"table": df}, root, fmt, partition_by)


def replace_all(tables: dict[str, DataFrame], root: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace several tables under one pointer: all of them change at once."""
    folder, spark = _fresh(), next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        w = df.write.format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(f"{root.rstrip('/')}/{folder}/{name}")
    write_pointer(spark, root, {name: f"{folder}/{name}" for name in tables})


def replace_split(checked: DataFrame, root: str, fmt: str = "parquet", flag: str = "_valid") -> None:
    """Silver and Quarantine from one job: the checked rows are written once,
    by ``flag``, and both sides change together (``read_split``)."""
    folder = _fresh()
    checked.write.format(fmt).partitionBy(flag).save(f"{root.rstrip('/')}/{folder}/split")
    write_pointer(checked.sparkSession, root, {"split": f"{folder}/split"})


def read(spark: SparkSession, root: str, name: str = "table", fmt: str = "parquet") -> DataFrame:
    """A table's current content."""
    parts = pointer(spark, root)
    if name not in parts:
        raise ValueError(f"{root} holds no table {name!r} yet")
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{parts[name]}")


def read_split(spark: SparkSession, root: str, valid: bool, fmt: str = "parquet", flag: str = "_valid") -> DataFrame:
    """One side of ``replace_split``."""
    return read(spark, root, "split", fmt).filter(F.col(flag) == F.lit(valid)).drop(flag)


def key_bucket(cols: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(buckets)).cast("int")


def _load_buckets(spark: SparkSession, root: str, parts: dict[str, str], fmt: str) -> DataFrame | None:
    """The given buckets from the folders that hold them."""
    folders: dict[str, list[str]] = {}
    for b, folder in parts.items():
        folders.setdefault(folder, []).append(b)
    out = None
    for folder, held in sorted(folders.items()):
        base = f"{root.rstrip('/')}/{folder}"
        df = spark.read.format(fmt).option("basePath", base).load([f"{base}/{BUCKET}={b}" for b in sorted(held, key=int)])
        out = df if out is None else out.unionByName(df)
    return out


def merge_buckets(spark: SparkSession, root: str, changes: DataFrame, key: Sequence[str],
                  merge: Callable[[DataFrame | None, DataFrame], DataFrame], buckets: int = 64, fmt: str = "parquet") -> list[int]:
    """Merge ``changes`` into a table cut by key bucket; returns the buckets
    written.  ``merge(old, new)`` gives the new content of the touched
    buckets: ``old`` is theirs so far (None where none of them exists yet),
    both come with the bucket column, and every touched bucket must keep a
    row.  All other buckets stay where they are.

    ``buckets`` fixes the cut at the first write; later ones use the number
    the pointer holds.  The changes are stored once (they give the list of
    buckets and feed the merge)."""
    from keelson.session import scratch_path
    parts = pointer(spark, root)
    buckets = int(parts.get("buckets", buckets))
    staged = scratch_path(spark, "changes")
    changes.withColumn(BUCKET, key_bucket(key, buckets)).write.parquet(staged)
    new = spark.read.parquet(staged)
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())   # at most ``buckets`` numbers
    if not touched:
        return []
    old = _load_buckets(spark, root, {str(b): parts[str(b)] for b in touched if str(b) in parts}, fmt)
    folder = _fresh()
    # rows of a bucket together, a large bucket split
    (merge(old, new).hint("rebalance", BUCKET)
     .write.format(fmt).partitionBy(BUCKET).save(f"{root.rstrip('/')}/{folder}"))
    write_pointer(spark, root, {**parts, **{str(b): folder for b in touched}, "buckets": str(buckets)})
    return touched


def read_buckets(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """All buckets' current content (without the bucket column)."""
    parts = {b: f for b, f in pointer(spark, root).items() if b != "buckets"}
    if not parts:
        raise ValueError(f"{root} holds no buckets yet")
    return _load_buckets(spark, root, parts, fmt).drop(BUCKET)


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete version folders that the pointer does not name any more; to be
    run when no reader can still be using them.  Returns their names."""
    used = {f.split("/")[0] for f in pointer(spark, root).values()}
    fs, p = _fs(spark, root)
    gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("version-") and s.getPath().getName() not in used]
    for x in gone:
        fs.delete(x, True)
    return sorted(x.getName() for x in gone)
