"""Left joins to lookup tables whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup table is broadcast up to this many bytes of text.
BROADCAST_BYTES = 32 * 1024 * 1024


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values as text plus eight per value, counted on the cluster."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns]
    return df.agg(F.sum(sum(sizes, F.lit(0).cast("bigint"))).alias("b")).first()["b"] or 0


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    measure: DataFrame | None = None,
) -> DataFrame:
    """Left join of `df` to `lookup` (unique by `key`).

    A lookup measured to be small is broadcast, so a key with a third of `df`, or a null one, costs nothing. A
    larger one is joined on the key and a salt taken from `spread_by`, which splits such a key over as many tasks as the
    session has shuffle partitions; rows without a key are spread the same way.
    `measure` may be a frame that is cheaper to measure and never smaller than the lookup.
    """
    if measured_bytes(lookup if measure is None else measure) <= broadcast_bytes:
        return df.join(F.broadcast(lookup), key, "left")
    tasks = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(tasks)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("_salt")
    salted = df.withColumn("_salt", salt).join(lookup.select("*", salts), [key, "_salt"], "left")
    return salted.drop("_salt")
