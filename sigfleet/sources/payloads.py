"""Raw signal payloads -> fetch outcomes and readings (S3, section 2.12).

A landed row is ``(pump_id, signal, detailed, fetched_at, http_status,
error, body BINARY)``. Decoding is per row with built-in expressions:

1. ``try_validate_utf8(cast(body as string))`` (null = not UTF-8),
2. strip one leading byte-order mark,
3. blank -> ``empty``,
4. kind from the first non-blank character: ``[`` array (``ok`` or
   ``empty``), ``{`` object, anything else (scalar, ``null``) malformed;
   broken JSON or text after the closing bracket -> ``malformed``.

A body is parsed once, into a variant that outcome, sizes and elements share
(:func:`decoded`). Only elements of ``ok`` bodies become readings, so an
object body never becomes a row of nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigfleet.schemas import BOM, READING_STRUCT

# Collector error codes that mean "nothing was fetched" (no body).
NO_PUMP = "no_pump"
NO_SIGNAL = "no_signal"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ASCII blanks, as stripped from a body before the emptiness test.
BLANKS = " \t\n\r\x0b\x0c"


def body_text(body) -> Column:
    """UTF-8 text of a binary body without its byte-order mark; null when
    the bytes are not valid UTF-8."""
    text = F.try_validate_utf8(_col(body).cast("string"))
    return F.when(text.startswith(BOM), F.substring(text, 2, 2147483647)).otherwise(text)


def _parsed(text, wanted) -> Column:
    """One parse of a body: the variant ``[body, hash of the body]``.

    Null unless ``wanted`` and valid JSON. :func:`_one` tells whether the body
    is one value: text beyond its end would be a further element, or would have
    to close the array early with the hash of itself.
    """
    t = _col(text)
    wrapped = F.concat(F.lit("["), t, F.lit(","), F.xxhash64(t).cast("string"), F.lit("]"))
    return F.when(wanted, F.try_parse_json(wrapped))


def _one(parts: str, text: str) -> Column:
    """Whether the parsed array ``parts`` is the one body ``text``."""
    own = F.try_variant_get(F.get(parts, F.lit(1)), "$", "bigint") == F.xxhash64(text)
    return F.coalesce((F.size(parts) == 2) & own, F.lit(False))


def is_json(text) -> Column:
    """Whether a text is one JSON value and nothing else; false for null."""
    t = _col(text)
    return _one(_parsed(t, F.lit(True)).cast("array<variant>"), t)


def decoded(landed: DataFrame) -> DataFrame:
    """``landed`` with ``outcome``, ``text`` and the body ``doc`` as a variant.

    Every body is parsed once; ``doc`` is null unless the outcome is ``ok`` (an
    array with elements) or ``object``. Transport comes first: nothing of a
    failed fetch is parsed.
    """
    err = F.col("error")
    failed = err.isNotNull() | F.coalesce(F.col("http_status") >= 400, F.lit(False))
    head = F.left(F.btrim("_text", F.lit(BLANKS)), F.lit(1))
    x = landed.select("*", body_text("body").alias("_text")).select("*", head.alias("_head"))
    wanted = ~failed & F.col("_head").isin("[", "{")
    x = x.select("*", _parsed("_text", wanted).cast("array<variant>").alias("_parts"))
    one = _one("_parts", "_text")
    # Elements of an array body; an object body has none.
    elements = F.when((F.col("_head") == "[") & one, F.get("_parts", F.lit(0)).cast("array<variant>"))
    x = x.select("*", elements.alias("_elements"), (one & (F.col("_head") == "{")).alias("_object"))
    n = F.size("_elements")
    outcome_ = (
        F.when(err == NO_PUMP, F.lit(NO_PUMP))
        .when(err == NO_SIGNAL, F.lit(NO_SIGNAL))
        .when(failed | F.col("_text").isNull(), F.lit("error"))
        .when(F.col("_head") == "", F.lit("empty"))
        .when(F.col("_elements").isNotNull(), F.when(n == 0, F.lit("empty")).otherwise(F.lit("ok")))
        .when(F.col("_object"), F.lit("object"))
        .otherwise(F.lit("malformed"))
    )
    doc = F.when(F.col("_object"), F.get("_parts", F.lit(0)))
    return x.select(
        *landed.columns, F.col("_text").alias("text"), outcome_.alias("outcome"),
        F.when(n > 0, F.col("_elements")).alias("elements"), doc.alias("doc"),
    )


# Texts that the service's JSON numbers may be given as.
NON_FINITE = ("NaN", "Infinity", "+Infinity", "-Infinity", "INF", "+INF", "-INF")


# Fields of an element as they come.
RAW_READING = "struct<time:string,value:variant,validity:variant>"


def variant_readings(elements) -> Column:
    """The reading struct of each element (a variant): null unless it is an
    object. A field of another type than the service's is null and costs only
    itself.

    One pass per step, since an expression used twice inside a pass would be
    evaluated twice.
    """
    raw = F.transform(elements, lambda e: e.try_cast(RAW_READING))
    texts = F.transform(
        raw,
        lambda r: F.when(
            r.isNotNull(),
            F.struct(
                r["time"].alias("time"), F.to_json(r["value"]).alias("value"), F.to_json(r["validity"]).alias("validity")
            ),
        ),
    )

    def reading(r: Column) -> Column:
        value, bare = r["value"], F.btrim(r["value"], F.lit('"'))
        quoted = value.startswith('"')
        number = F.when(quoted, F.when(bare.isin(*NON_FINITE), bare)).otherwise(value)
        whole = F.when(F.regexp_like(r["validity"], F.lit("^-?[0-9]+$")), r["validity"])
        fields = F.struct(
            r["time"].alias("time"), number.try_cast("double").alias("value"), whole.try_cast("int").alias("validity")
        )
        return F.when(r.isNotNull(), fields)

    return F.transform(texts, reading)


def array_elements(text) -> Column:
    """The elements of a JSON array, each as JSON text (a bad one is only
    itself; a JSON null is a null)."""
    return F.from_json(_col(text), "array<string>")


def reading_of(element) -> Column:
    """A reading struct from an element's text; null unless it is an object."""
    e = _col(element)
    is_object = F.startswith(F.btrim(e, F.lit(BLANKS)), F.lit("{"))
    return F.when(is_object, F.from_json(e, READING_STRUCT))


def fetch_outcomes(landed: DataFrame) -> DataFrame:
    """``(pump_id, signal, detailed, fetched_at, outcome)`` plus the three
    historical availability booleans kept apart:

    * ``is_nonempty``: the payload held at least one reading,
    * ``is_not_null``: anything came back that is not a literal ``null``
      (the client returned ``[]`` for failures, so this is true for them),
    * ``is_not_empty_object``: not ``{}`` (an empty array still counts).
    """
    return decoded(landed).select("pump_id", "signal", "detailed", "fetched_at", *_outcome())


def _outcome() -> list[Column]:
    """The outcome and its three booleans, of :func:`decoded` rows."""
    t = F.btrim("text", F.lit(BLANKS))
    return [
        F.col("outcome"),
        (F.col("outcome") == "ok").alias("is_nonempty"),
        F.coalesce(t != "null", F.lit(True)).alias("is_not_null"),
        F.coalesce(~F.regexp_like(t, F.lit(r"^\{\s*\}$")), F.lit(True)).alias("is_not_empty_object"),
    ]


OUTCOME = ["outcome", "is_nonempty", "is_not_null", "is_not_empty_object"]


def parsed(landed: DataFrame, *more) -> DataFrame:
    """One row per payload with its outcome, its three booleans and its
    ``readings`` (an array): what :func:`fetch_outcomes` and
    :func:`readings_from_landed` give, from one pass over the bodies."""
    return decoded(landed).select(
        "pump_id", "signal", "detailed", "fetched_at", *more, *_outcome(), variant_readings("elements").alias("readings")
    )


def readings_of_parsed(payloads: DataFrame, *more) -> DataFrame:
    """Canonical readings of :func:`parsed` payloads."""
    x = payloads.select("pump_id", "signal", "detailed", *more, F.posexplode("readings").alias("pos", "_r"))
    return _canonical(x.where(F.col("_r").isNotNull()), *more)


def readings_from_landed(landed: DataFrame, *more) -> DataFrame:
    """Canonical readings from the ``ok`` payloads; ``pos`` = index in payload.

    Elements are decoded one by one: one that is no object gives no reading
    and costs only itself (:func:`payload_elements` counts them). ``more``
    columns of the landed rows come along.
    """
    return _canonical(_elements(landed, *more).where(F.col("_r").isNotNull()), *more)


def _canonical(x: DataFrame, *more) -> DataFrame:
    return x.select(
        "pump_id",
        "signal",
        "detailed",
        reading_time(F.col("_r.time")).alias("time"),
        F.col("_r.value").alias("value"),
        F.col("_r.validity").alias("validity"),
        F.col("pos").cast("long").alias("pos"),
        *more,
    )


def _elements(landed: DataFrame, *more) -> DataFrame:
    """The elements of the ``ok`` payloads with their readings.

    An outer generator: the filter that an inner one infers on its array would
    be pushed below the parse and parse once more.
    """
    x = decoded(landed).select(
        "pump_id", "signal", "detailed", "fetched_at", *more, variant_readings("elements").alias("_a")
    )
    x = x.select("pump_id", "signal", "detailed", "fetched_at", *more, F.posexplode_outer("_a").alias("pos", "_r"))
    return x.where("pos IS NOT NULL")


def payload_sizes(landed: DataFrame) -> DataFrame:
    """A1: per pump and series the readings of list results (``points``) and
    the number of keys of object results (``keys``), which are shown but
    never enter a total."""
    objects = F.filter("elements", lambda e: e.try_cast("map<string,variant>").isNotNull())
    keys = F.size(F.map_keys(F.col("doc").try_cast("map<string,variant>")))
    n = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long")
    x = decoded(landed).select("pump_id", "signal", "detailed", "outcome", F.size(objects).alias("_n"), keys.alias("_k"))
    sums = x.groupBy("pump_id", "signal", "detailed").agg(
        F.count_if(F.col("outcome").isin("ok", "object")).alias("_any"), n(F.col("_n")).alias("points"), n(F.col("_k")).alias("keys")
    )
    return sums.where("_any > 0").drop("_any")


def payload_elements(landed: DataFrame) -> DataFrame:
    """Per pump and series: array elements, and those that are no reading."""
    return _elements(landed).groupBy("pump_id", "signal", "detailed").agg(
        F.count(F.lit(1)).alias("elements"), F.count_if(F.col("_r").isNull()).alias("rejected")
    )


def reading_time(text) -> Column:
    """Service time text (``...Z``, UTC) -> ``TIMESTAMP_NTZ`` wall clock."""
    return F.regexp_replace(_col(text), "Z$", "").try_cast("timestamp_ntz")


def _zero_length_files(spark, root: str) -> list:
    """``(path, modification time)`` of the zero-byte files under ``root``.

    Spark's file scan skips zero-length files, yet an empty body is an
    outcome to count; one recursive listing (metadata only) finds them.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    it = fs.listFiles(path, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if st.getLen() == 0 and not name.startswith(("_", ".")):
            out.append((st.getPath().toString(), st.getModificationTime()))
    return out


def empty_files(spark, root: str) -> DataFrame:
    """``path, modified`` (milliseconds) of the zero-byte files under ``root``."""
    return spark.createDataFrame(_zero_length_files(spark, root), "path string, modified long")


def _text_of(files: DataFrame, name: str | None) -> Column:
    """A key column as text. For a ``name=value`` folder the exact text of
    the path is used (partition type inference would turn ``007`` into 7)."""
    if not name:
        return F.lit(None).cast("string")
    from_path = F.nullif(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit(""))
    return F.coalesce(from_path, F.col(name).cast("string"))


def read_landed_files(spark, path: str, pump_id: str | None = None, signal: str | None = None) -> DataFrame:
    """Landed payload files (one body per file) as landed rows.

    ``binaryFile`` reads each file whole in one task; a partitioned layout
    (``pump_id=…/signal=…``) carries the pump and signal, and where present
    ``detailed``, ``http_status`` and ``error`` (a failed fetch is landed as
    an empty file under its code).
    Zero-byte files, which the scan skips, are added back as empty bodies.
    """
    files = spark.read.format("binaryFile").load(path)
    zero = _zero_length_files(spark, path)
    if zero:
        extra = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
        z = spark.createDataFrame(zero, "path string, _ms long").select(
            "path",
            (F.col("_ms") / 1000).cast("timestamp").alias("modificationTime"),
            F.lit(0).cast("long").alias("length"),
            F.lit(b"").cast("binary").alias("content"),
            *[F.regexp_extract("path", f"/{c}=([^/]+)/", 1).cast(files.schema[c].dataType).alias(c) for c in extra],
        )
        files = files.unionByName(z)
    return landed_rows(files, pump_id, signal)


def landed_rows(files: DataFrame, pump_id: str | None = None, signal: str | None = None) -> DataFrame:
    """Landed rows of ``binaryFile`` rows (a table or a stream of them)."""
    here = lambda name: F.col(name) if name in files.columns else F.lit(None)
    return files.select(
        _text_of(files, pump_id).alias("pump_id"),
        _text_of(files, signal).alias("signal"),
        F.coalesce(here("detailed").cast("string").try_cast("boolean"), F.lit(False)).alias(
            "detailed"
        ),
        F.to_utc_timestamp(F.col("modificationTime").cast("timestamp_ntz"), F.current_timezone())
        .cast("timestamp_ntz")
        .alias("fetched_at"),
        F.coalesce(here("http_status").cast("string").try_cast("int"), F.lit(200)).alias(
            "http_status"
        ),
        here("error").cast("string").alias("error"),
        F.col("content").alias("body"),
    )
