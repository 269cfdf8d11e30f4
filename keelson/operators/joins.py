"""Join helpers: broadcast only behind a size check, and a range lookup
that still scales when its band table is too large to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Row bound under which a side is broadcast (a few MB for narrow rows).
MAX_BROADCAST_ROWS = 100_000
# Band tables up to this many rows are compared band by band; larger ones
# take the as-of path, so no value is ever paired with thousands of bands.
MAX_BANDS = 256


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Size check: at most ``max_rows`` rows (counts at most max_rows + 1
    rows, so the check stays cheap on a large table)."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it passed the size check, else ``df`` as is,
    leaving the strategy to Spark (sort-merge join, AQE skew handling)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def range_lookup(values: DataFrame, value_col: str, bands: DataFrame, min_col: str,
                 max_rows: int = MAX_BANDS) -> DataFrame:
    """For each row of ``values``, the band with the largest ``min_col`` <=
    value (NULL band columns when the value is below every band).  Band
    minimums must be unique.

    Small band table (size-checked): a broadcast range join against the
    bands as half-open intervals [min, next min); each value matches at most
    one band.  Large band table: an as-of lookup without any pairwise join:
    values and band starts are range-partitioned together in value order
    (band starts first on ties), a running count of band starts gives each
    value the ordinal of its band, and the band is joined by that ordinal.
    Both paths compare in the common type of the two columns and return the
    same columns: those of ``values``, then the bands' others.
    """
    from keelson.operators.dims import dense_key
    from keelson.operators.sequences import ordered_scan
    band_cols = list(bands.columns)
    if fits_broadcast(bands, max_rows):
        w = Window.orderBy(F.col(min_col))
        b = bands.withColumn("__upper", F.lead(F.col(min_col)).over(w))   # size-checked table
        cond = (F.col(value_col) >= F.col(min_col)) & (F.col("__upper").isNull() | (F.col(value_col) < F.col("__upper")))
        out = values.alias("v").join(F.broadcast(b).alias("b"), cond, "left")
        return out.select("v.*", *[f"b.{c}" for c in band_cols if c not in values.columns])
    ranked = dense_key(bands, [min_col], "__ord")
    probes = values.select("*", F.col(value_col).alias("__v"), F.lit(1).alias("__probe"))
    starts = ranked.select(F.col(min_col).alias("__v"), F.lit(0).alias("__probe"))
    both = probes.unionByName(starts, allowMissingColumns=True).withColumn("__g", F.lit(0))
    scanned = ordered_scan(both, ["__g"], ["__v", "__probe"],
                           running_sum={"__k": F.when(F.col("__probe") == 0, 1).otherwise(0)})
    hit = scanned.filter(F.col("__probe") == 1).withColumn("__ord_hit", F.col("__k") - 1)
    out = hit.join(ranked.withColumnRenamed("__ord", "__ord_b"), F.col("__ord_hit") == F.col("__ord_b"), "left")
    return out.select(*values.columns, *[c for c in band_cols if c not in values.columns])
