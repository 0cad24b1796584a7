"""Write a k-times larger copy of the driver tables for scaling runs.

Usage: python tools/replicate.py <src_sf_dir> <out_dir> [k]

``events`` is replicated k times (copy r gets ``event_id + r * n`` and its
times shifted by ``30 * r`` days, so keys stay unique and ranges grow);
the other tables are copied. The copy is produced by a generator
(``explode(sequence(...))``), not a join.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from sigfleet.session import build_session  # noqa: E402


def main(argv):
    src, out = argv[1].rstrip("/"), argv[2].rstrip("/")
    k = int(argv[3]) if len(argv) > 3 else 10
    spark = build_session(master="local[8]", shuffle_partitions=8)
    ev = spark.read.parquet(f"{src}/events.parquet")
    n = ev.agg(F.max("event_id") + 1).first()[0]
    x = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_r"))
    x = x.select(
        (F.col("event_id") + F.col("_r") * n).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("_r") * 30)).alias("ts"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
    x.repartition(k).write.mode("overwrite").parquet(f"{out}/events.parquet")
    for t in ("customer", "orders", "supplier", "nation", "region"):
        spark.read.parquet(f"{src}/{t}.parquet").write.mode("overwrite").parquet(f"{out}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
