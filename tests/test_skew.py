"""A pump holding a third of all readings must not reach the shuffle whole.

The executed plan's shuffle metrics show how many rows crossed each
exchange; map-side partial aggregation / partial window limits keep that
bounded by (map tasks x keys), not by the hot pump's row count.
"""

import datetime as dt

from pyspark.sql import functions as F

from sigfleet.operators import latest, reports, samples

MAPS = 8
N = 60_000


def skewed(spark):
    """Readings where pump 0 holds one third of the rows."""
    base = spark.range(N, numPartitions=MAPS)
    hot = F.col("id") % 3 == 0
    pump = F.when(hot, F.lit(0)).otherwise(F.col("id") % 200 + 1)
    sig = F.element_at(F.array(*[F.lit(s) for s in ("status", "rawpower", "speed", "fault", "inservice")]), (F.col("id") % 5 + 1).cast("int"))
    t0 = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    return base.select(
        pump.cast("long").alias("pump_id"),
        sig.alias("signal"),
        F.lit(False).alias("detailed"),
        (t0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("time"),
        (F.col("id") % 97).cast("double").alias("value"),
        F.lit(0).alias("validity"),
        F.col("id").alias("pos"),
    )


def shuffled_rows(df):
    """Total records written by the shuffles of the executed plan.

    The frame itself is executed (its results are small: one row per key)
    so that its own adaptive plan becomes final and carries the metrics."""
    df.collect()
    qe = df._jdf.queryExecution()
    text = qe.executedPlan().toString()
    plan = qe.executedPlan()
    # Walk the final adaptive plan and sum shuffle write metrics.
    total = 0
    stack = [plan]
    seen = 0
    while stack:
        node = stack.pop()
        seen += 1
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            stack.append(node.plan())
            continue
        if name == "Exchange" and node.metrics().contains("shuffleRecordsWritten"):
            total += node.metrics().apply("shuffleRecordsWritten").value()
        it = node.children().iterator()
        while it.hasNext():
            stack.append(it.next())
    assert seen > 1, text
    return total


def test_skewed_input_has_hot_pump(spark):
    r = skewed(spark)
    hot = r.where("pump_id = 0").count()
    assert hot * 3 == N


def test_latest_shuffles_one_row_per_key_per_task(spark):
    r = skewed(spark)
    keys = r.select("pump_id", "signal").distinct().count()
    rows = shuffled_rows(latest.latest_per_signal(r))
    assert 0 < rows <= MAPS * keys
    assert rows < N / 10


def test_top_k_shuffles_k_rows_per_key_per_task(spark):
    r = skewed(spark)
    keys = r.select("pump_id", "signal").distinct().count()
    rows = shuffled_rows(samples.series_sample(r, 3))
    assert 0 < rows <= 3 * MAPS * keys


def test_flags_shuffle_one_row_per_pump_per_task(spark):
    r = skewed(spark)
    rows = shuffled_rows(reports.pump_flags(r))
    assert 0 < rows <= MAPS * 201
