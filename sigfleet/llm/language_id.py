"""Language of documents by a bidirectional GRU over bytes.

The network (:mod:`sigfleet.llm.bigru`) is trained on a bounded sample of
labelled documents, in one task; it labels every position of every whole text,
and a document's probabilities are the means over its positions.

Learning sees text and label only, prediction text only. The sample takes at
most ``per_language`` documents of each language (those of smallest hash), so
fitting costs the same at every size of the corpus. Its training windows are
drawn over the whole of each text: one at a hashed place in each of
``TRAIN_WINDOWS`` equal parts; a text too short for that gives all of itself.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
without a single labelled document everything is ``und``; ties between
languages go to the first by name; repeated rows get equal results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.llm import bigru
from sigfleet.llm.common import stored, whole

# Characters of a training window, and windows of a text.
TRAIN_WINDOW, TRAIN_WINDOWS = 64, 4
# Bits of the hash by which documents of a language are counted to find the cut.
PREFIX = 10
UNKNOWN = "und"


def has_letter(text: Column) -> Column:
    return whole(text).rlike(r"\p{L}")


def training_sample(
    spark: SparkSession,
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 1_500,
) -> DataFrame:
    """Stored ``lang, windows``: at most about ``per_language`` per language.

    The cut is found on ids and labels alone (texts are not read for it): the
    hash of the ``per_language``-th document of each language. Counts by hash
    prefix tell which documents can lie below it, so that no task ranks all
    documents of a language.
    """
    h = F.xxhash64(F.lit("sample"), F.col(id_col))
    ids = docs.where(learn & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), h.alias("h")
    )
    prefix = F.shiftright("h", 64 - PREFIX)
    counted = ids.groupBy("lang", prefix.alias("prefix")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("prefix")) - F.col("n")
    enough = (
        counted.withColumn("before", before)
        .where(F.col("before") < per_language)
        .groupBy("lang")
        .agg(F.max("prefix").alias("upto"))
    )
    near = ids.join(F.broadcast(stored(spark, enough, "language-prefixes")), "lang").where(prefix <= F.col("upto"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    cuts = (
        near.withColumn("rank", rank)
        .where(F.col("rank") <= per_language)
        .groupBy("lang")
        .agg(F.max("h").alias("cut"))
    )
    text = whole(F.col(text_col))
    labelled = docs.where(learn & F.col(id_col).isNotNull() & has_letter(F.col(text_col))).select(
        F.col(lang_col).alias("lang"), h.alias("h"), training_windows(text, F.col(id_col)).alias("windows")
    )
    # One row per language (as many as the model has outputs): broadcast, so
    # that only the chosen windows are shuffled, not those of a hot language.
    chosen = labelled.join(F.broadcast(stored(spark, cuts, "language-cuts")), "lang").where("h <= cut")
    # Rows that repeat an id share its hash; the rank bounds them as well.
    again = F.row_number().over(Window.partitionBy("lang").orderBy("h", "windows"))
    return stored(
        spark,
        chosen.withColumn("rank", again)
        .where(F.col("rank") <= per_language)
        .select("lang", "windows"),
        "language-sample",
    )


def training_windows(text: Column, key: Column) -> Column:
    """Windows of ``TRAIN_WINDOW`` characters drawn over the whole of ``text``."""
    room = F.length(text) - TRAIN_WINDOW * TRAIN_WINDOWS
    out = []
    for i in range(TRAIN_WINDOWS):
        part = F.floor(F.greatest(room, F.lit(0)) / TRAIN_WINDOWS)
        at = part * i + F.pmod(F.xxhash64(F.lit(f"start {i}"), key), part + 1) + TRAIN_WINDOW * i
        out.append(F.substring(text, (at + 1).cast("int"), F.lit(TRAIN_WINDOW)))
    return F.array(*out)


def _fitted(tables: Iterator[pa.RecordBatch], hidden: int) -> Iterator[pa.RecordBatch]:
    rows = [r for b in tables for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["lang"], r["windows"]))
    if not rows:
        return
    names = sorted({r["lang"] for r in rows})
    parts = []
    for r in rows:
        label = names.index(r["lang"])
        for w in r["windows"]:
            data = np.frombuffer(w.encode("utf-8", "surrogatepass"), np.uint8)[:TRAIN_WINDOW]
            if len(data):
                parts.append((data, label))
    windows = np.zeros((TRAIN_WINDOW, len(parts)), np.uint8)
    used = np.zeros((TRAIN_WINDOW, len(parts)), np.float32)
    labels = np.array([label for _, label in parts])
    for i, (data, _) in enumerate(parts):
        windows[: len(data), i] = data
        used[: len(data), i] = 1
    model = bigru.train(windows, labels, used, len(names), hidden)
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps((names, model))], pa.binary())})


def fit(sample: DataFrame, hidden: int = 8):
    """(languages, model), or None for an empty sample; trained in one task."""
    rows = (
        sample.coalesce(1)
        .mapInArrow(lambda it: _fitted(it, hidden), "model binary")
        .collect()
    )  # a few kilobytes
    return pickle.loads(rows[0]["model"]) if rows else None


def _predicted(batches, names: list[str], model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        prob = bigru.pooled(model, data)
        best = prob.argmax(axis=1)
        known = np.array(b.column("letters").to_pylist(), bool)
        yield pa.RecordBatch.from_arrays(
            [
                *[b.column(c) for c in b.schema.names if c not in ("text", "letters")],
                pa.array([names[i] if k else UNKNOWN for i, k in zip(best, known, strict=True)]),
                pa.array(np.where(known, np.minimum(1.0, prob.max(axis=1)), 0.0)),
            ],
            [*[c for c in b.schema.names if c not in ("text", "letters")], "lang_pred", "score"],
        )


def predict(docs: DataFrame, fitted, text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``keep`` columns of every document with ``lang_pred`` and ``score``."""
    kept = [F.col(c) for c in keep]
    if fitted is None:
        return docs.select(
            *kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")
        )
    names, model = fitted
    base = docs.select(
        *kept, F.col(text_col).alias("text"), has_letter(F.col(text_col)).alias("letters")
    )
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema if f.name in keep
    )
    return base.mapInArrow(
        lambda it: _predicted(it, names, model),
        f"{schema}{', ' if schema else ''}lang_pred string, score double",
    )
