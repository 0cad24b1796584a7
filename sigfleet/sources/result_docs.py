"""Query result documents at rest as input.

A document is ``{bomba{id,name}, endpoint, rango{inicio,fin}, datos,
timestamp_consulta}`` where ``datos`` is an array of readings (one signal)
or an object endpoint -> array (bundles). ``datos`` is declared a string
and branched on its first character, so both shapes read with one schema.

``multi_line=True`` reads one pretty-printed document per file, as the
client writes them; ``False`` reads JSON Lines, which is how a collector
should land documents at volume (no whole-file tasks, no small files).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.schemas import ENDPOINTS, RESULT_DOC_SCHEMA
from sigfleet.sources.payloads import array_elements, reading_of, reading_time


def _endpoint_map(part: int) -> Column:
    """Literal map endpoint name -> signal code (part 0) or detailed (part 1)."""
    kv = []
    for name, (codes, detailed) in ENDPOINTS.items():
        if len(codes) == 1:
            kv += [F.lit(name), F.lit(codes[0] if part == 0 else detailed)]
    return F.create_map(*kv)


def read_result_docs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    docs = spark.read.schema(RESULT_DOC_SCHEMA).json(path, multiLine=multi_line)
    return result_doc_readings(docs)


def result_doc_readings(docs: DataFrame) -> DataFrame:
    """Readings ``(pump_id, name, endpoint, signal, detailed, time, value,
    validity, pos)`` of result documents; empty series give no rows."""
    datos = F.col("datos")
    head = F.substring(F.regexp_replace(datos, r"^\s+", ""), 1, 1)
    parts = F.when(head == "[", F.map_from_arrays(F.array(F.coalesce(F.col("endpoint"), F.lit(""))), F.array(datos))).when(
        head == "{", F.from_json(datos, "map<string,string>")
    )
    base = docs.select(
        F.col("bomba.id").alias("pump_id"),
        F.col("bomba.name").alias("name"),
        "endpoint",
        F.explode(parts).alias("_ep", "_arr"),
    )
    x = base.select(
        "pump_id", "name", "endpoint", "_ep", F.posexplode(array_elements("_arr")).alias("pos", "_e")
    ).withColumn("_r", reading_of("_e"))
    return x.where(F.col("_r").isNotNull()).select(
        "pump_id",
        "name",
        "endpoint",
        F.coalesce(F.try_element_at(_endpoint_map(0), F.col("_ep")), F.col("_ep")).alias("signal"),
        F.coalesce(F.try_element_at(_endpoint_map(1), F.col("_ep")), F.lit(False)).alias("detailed"),
        reading_time(F.col("_r.time")).alias("time"),
        F.col("_r.value").alias("value"),
        F.col("_r.validity").alias("validity"),
        F.col("pos").cast("long").alias("pos"),
    )
