"""Quality classifier by co-training two views of a document.

View *content*: hashed byte trigrams of the whole text. View *metadata*: the
page's source, language, recorded length and layout counts (lines, blank
lines, line length, shares of capitals, digits, marks). One logistic model
per view is trained on the labelled sample; in each round either model labels
the unlabelled documents it is most sure of, for the other model to learn
from. In the end each view's score is calibrated on labelled rows kept apart,
and a small logistic model over the two calibrated scores gives the result.

At most ``max_labelled`` labelled documents (those of smallest hash) are
learned from as labelled; all others are the unlabelled pool. Their features
are stored once. A round reads them twice: to count the margins of the
documents either model is sure of, which gives the cut of the top share, and
to fit on all documents above the cuts so far, in parts whose coefficients
are averaged by weight (so they depend slightly on how the table is split).
Scoring covers all documents, whole texts, without a shuffle.

Defined cases: a null or empty text has the metadata of an empty page; null
metadata is a value of its own; a null label, or a document whose repeated
label rows disagree, is not learned from; without labels of both classes
every score is 0.5; repeated rows get equal results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.llm.common import stored

CONTENT_DIM = 1024
SOURCE_DIM, LANG_DIM, LAYOUT_DIM = 32, 16, 10
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "#*$%&|<>!?~^=+_@{}[]\\/"]] = True


def content_view(data: np.ndarray) -> np.ndarray:
    """Hashed byte trigrams: square roots of their shares."""
    out = np.zeros(CONTENT_DIM, np.float32)
    if len(data) >= 3:
        d = data.astype(np.uint32)
        h = (d[:-2] * np.uint32(0x9E3779B1)) ^ (d[1:-1] * np.uint32(0x85EBCA6B))
        h ^= d[2:] * np.uint32(0xC2B2AE35)
        h = (h * np.uint32(0x27D4EB2F)) >> np.uint32(22)
        out = np.sqrt(np.bincount(h, minlength=CONTENT_DIM) / np.float32(len(h))).astype(np.float32)
    return out


def metadata_view(data: np.ndarray, lang, source, n_chars) -> np.ndarray:
    """Source, language, recorded length and layout counts."""
    out = np.zeros(SOURCE_DIM + LANG_DIM + LAYOUT_DIM, np.float32)
    out[crc32(repr(source).encode()) % SOURCE_DIM] = 1.0
    out[SOURCE_DIM + crc32(repr(lang).encode()) % LANG_DIM] = 1.0
    n = max(1, len(data))
    by = np.bincount(data, minlength=256)
    lines = by[10] + 1
    spaces = by[32] + by[9] + by[10] + by[13]
    recorded = max(0, n_chars) if n_chars is not None else -1
    out[-LAYOUT_DIM:] = (
        np.log1p(max(0, recorded)) / 10,
        float(recorded < 0),
        np.log1p(lines) / 5,
        np.log1p(n / lines) / 8,
        by[65:91].sum() / n * 4,
        by[48:58].sum() / n * 4,
        by[_MARKS].sum() / n * 8,
        spaces / n * 2,
        by[44] / n * 8,
        by[46] / n * 8,
    )
    return out


def _views(row) -> tuple[np.ndarray, np.ndarray]:
    text, lang, source, n_chars = row
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return content_view(data), metadata_view(data, lang, source, n_chars)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, steps: int = 150, l2: float = 1e-4):
    """Weighted logistic regression by Adam; a row of coefficients, bias last.

    Runs in the type of ``x``: mixed types would copy the matrix in each step.
    """
    kind = x.dtype
    x = np.hstack([x, np.ones((len(x), 1), kind)])
    y, w = y.astype(kind), (w / w.sum()).astype(kind)
    c = np.zeros(x.shape[1], kind)
    m, s = np.zeros_like(c), np.zeros_like(c)
    for t in range(1, steps + 1):
        g = x.T @ (w * (_sigmoid(x @ c) - y)) + kind.type(l2) * c
        m += kind.type(0.1) * (g - m)
        s += kind.type(0.01) * (g * g - s)
        rate = kind.type(0.1 / (1 - 0.9**t))
        c -= rate * m / (np.sqrt(s / kind.type(1 - 0.99**t)) + kind.type(1e-9))
    return c


def _balanced(y: np.ndarray) -> np.ndarray:
    """Weights that give both classes the same total."""
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    return np.where(y == 1, 0.5 / share, 0.5 / (1 - share))


def _margin(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return x @ c[:-1] + c[-1]


def cotrain(
    views: tuple[np.ndarray, np.ndarray],
    y: np.ndarray,
    labelled: np.ndarray,
    calibration: np.ndarray,
    rounds: int = 4,
    share: float = 0.1,
    sure: float = 0.95,
) -> dict:
    """Model of both views in one process; ``y`` counts where ``labelled``.

    The plain form of :func:`fit`.

    In each round each view passes on, per class, the ``share`` of the pool
    it is most sure of, if its probability is at least ``sure``.
    """
    pool = ~labelled
    known = [labelled & ~calibration, labelled & ~calibration]
    target = [y.astype(float).copy(), y.astype(float).copy()]
    models = [None, None]
    for r in range(rounds + 1):
        for v in (0, 1):
            k = known[v]
            weight = _balanced(target[v][k]) * np.where(labelled[k], 1.0, 0.5)
            models[v] = _logistic(views[v][k], target[v][k], weight)
        if r == rounds or not pool.any():
            break
        for v in (0, 1):
            other = 1 - v
            p = _sigmoid(_margin(views[v], models[v]))
            for label, q in ((1.0, p), (0.0, 1 - p)):
                free = np.flatnonzero(pool & ~known[other] & (q >= sure))
                best = free[np.argsort(-q[free], kind="stable")][: max(1, int(share * pool.sum()))]
                known[other][best] = True
                target[other][best] = label
    return _calibrated(models, [x[calibration] for x in views], y[calibration])


def _calibrated(models: list, views, y: np.ndarray) -> dict:
    """The whole model, from both views' models and the rows kept apart."""
    yc = y.astype(float)
    calibrated = []
    logits = []
    for v in (0, 1):
        m = _margin(views[v], models[v])[:, None]
        calibrated.append(_logistic(m, yc, np.ones(len(yc)), 400))
        logits.append(_margin(m, calibrated[v]))
    joint = _logistic(np.stack(logits, axis=1), yc, np.ones(len(yc)), 400)
    return {"models": models, "calibrated": calibrated, "joint": joint}


def _scores(model: dict, content: np.ndarray, meta: np.ndarray):
    logits = [
        _margin(_margin(x, model["models"][v])[:, None], model["calibrated"][v])
        for v, x in enumerate((content, meta))
    ]
    joint = _sigmoid(_margin(np.stack(logits, axis=1), model["joint"]))
    return _sigmoid(logits[0]), _sigmoid(logits[1]), joint


def training_sample(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 8_000,
    id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """Stored rows to fit on: ``content, meta, label, h`` of every document.

    Labelled ids are cut by hash before any text is read; the cut is bounded,
    so the broadcast is.
    """
    given = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("lab"))
        .where("id is not null and lab is not null")
        .groupBy("id")
        .agg(F.min("lab").alias("lo"), F.max("lab").alias("hi"))
        .where("lo = hi")
        .select("id", (F.col("lo") == 1).cast("int").alias("label"))
    )
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null")
    known = (
        given.join(ids.distinct(), "id", "left_semi")
        .withColumn("h", F.xxhash64(F.lit("co"), "id"))
        .orderBy("h", "id")
        .limit(max_labelled)
    )
    known = stored(spark, known, "cotraining-known")
    rows = docs.select(
        F.col(id_col).alias("id"),
        "text", "lang", "source", F.col("n_chars").cast("long"),
    )
    # Rows that repeat a labelled id: one of them, by text.
    one = F.row_number().over(Window.partitionBy("id").orderBy("text"))
    labelled = (
        rows.join(F.broadcast(known), "id").withColumn("nth", one).where("nth = 1").drop("nth", "id")
    )
    pool = (
        rows.join(F.broadcast(known.select("id")), "id", "left_anti")
        .drop("id")
        .select("*", F.lit(None).cast("int").alias("label"), F.lit(0).cast("long").alias("h"))
    )
    kind = "content binary, meta binary, label int, h long"
    return stored(
        spark,
        labelled.select(*pool.columns).unionByName(pool).mapInArrow(_features, kind),
        "cotraining-sample",
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        content, meta = [], []
        for row in zip(*(b.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))):
            c, m = _views(row)
            content.append(c.tobytes()), meta.append(m.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(content, pa.binary()), pa.array(meta, pa.binary()), b.column("label"), b.column("h")],
            ["content", "meta", "label", "h"],
        )


def _arrays(b: pa.RecordBatch):
    """Both views, labels (-1: none) and hashes of a batch of the sample."""
    views = tuple(
        np.frombuffer(b"".join(b.column(c).to_pylist()), np.float32).reshape(b.num_rows, -1)
        for c in ("content", "meta")
    )
    y = np.array([-1 if x is None else x for x in b.column("label").to_pylist()], np.int64)
    return views, y, np.array(b.column("h").to_pylist(), np.int64)


# Margins from the surest part of the scale are counted in this many bins.
BINS = 4096
TOP_MARGIN = 30.0
# Rows that are fitted at a time.
PART = 16_000


def _bin(margin: np.ndarray, sure: float) -> np.ndarray:
    """Bin of a margin, -1 for one below ``sure``."""
    low = np.log(sure / (1 - sure))
    at = np.floor((margin - low) / (TOP_MARGIN - low) * BINS)
    return np.clip(at, -1, BINS - 1).astype(np.int64)


def _known(views, y, calibrates, steps: list, sure: float):
    """What each view knows after ``steps``: masks and labels, per row."""
    known = [(y >= 0) & ~calibrates, (y >= 0) & ~calibrates]
    target = [y.astype(float), y.astype(float)]
    for models, cuts in steps:
        for v in (0, 1):
            m = _margin(views[v], models[v])
            for label, q in ((1, m), (0, -m)):
                take = (y < 0) & ~known[1 - v] & (_bin(q, sure) >= cuts[v, label])
                known[1 - v][take] = True
                target[1 - v][take] = label
    return known, target


def _counted(batches, models, steps, sure) -> Iterator[pa.RecordBatch]:
    """``slot, bin, n`` of the rows that each view may pass on; slot -1: the pool."""
    found = np.zeros((4, BINS), np.int64)
    pool = 0
    for b in batches:
        if not b.num_rows:
            continue
        views, y, _ = _arrays(b)
        known, _ = _known(views, y, np.zeros(len(y), bool), steps, sure)
        pool += int((y < 0).sum())
        for v in (0, 1):
            m = _margin(views[v], models[v])
            free = (y < 0) & ~known[1 - v]
            for label, q in ((1, m), (0, -m)):
                at = _bin(q, sure)[free]
                found[2 * v + label] += np.bincount(at[at >= 0], minlength=BINS)
    slot, at = np.nonzero(found)
    yield pa.RecordBatch.from_pydict({
        "slot": pa.array([-1, *slot.tolist()], pa.int32()),
        "bin": pa.array([0, *at.tolist()], pa.int32()),
        "n": pa.array([pool, *found[slot, at].tolist()], pa.int64()),
    })


def _part_models(batches, calibration, steps, sure) -> Iterator[pa.RecordBatch]:
    """``view, weight, c``: models of either view on parts of the rows it knows."""
    held: tuple[list, list] = ([], [])

    def fitted(v: int) -> pa.RecordBatch:
        x, t, w = (np.concatenate(part) for part in zip(*held[v]))
        held[v].clear()
        c = _logistic(x, t, _balanced(t) * w)
        return pa.RecordBatch.from_pydict({
            "view": pa.array([v], pa.int32()),
            "weight": pa.array([float(w.sum())], pa.float64()),
            "c": pa.array([c.astype(float).tolist()], pa.list_(pa.float64())),
        })

    for b in batches:
        if not b.num_rows:
            continue
        views, y, h = _arrays(b)
        known, target = _known(views, y, (y >= 0) & np.isin(h, calibration), steps, sure)
        for v in (0, 1):
            k = known[v]
            if k.any():
                held[v].append((views[v][k], target[v][k], np.where(y[k] >= 0, 1.0, 0.5)))
            if sum(len(t) for _, t, _ in held[v]) >= PART:
                yield fitted(v)
    for v in (0, 1):
        if held[v]:
            yield fitted(v)


def _on_labelled(batches, models) -> Iterator[pa.RecordBatch]:
    """First models and the hashes that calibrate, or the whole model from ``models``."""
    parts = [_arrays(b) for b in batches if b.num_rows]
    if not parts:
        return
    h = np.concatenate([p[2] for p in parts])
    order = np.argsort(h, kind="stable")
    y = np.concatenate([p[1] for p in parts])[order]
    views = [np.concatenate([p[0][v] for p in parts])[order] for v in (0, 1)]
    # Every fourth labelled row calibrates; both classes are needed in both parts.
    calibration = np.arange(1, len(y) + 1) % 4 == 0
    for part in (~calibration, calibration):
        if len(np.unique(y[part])) < 2:
            return
    if models is None:
        t = y[~calibration].astype(float)
        out = ([_logistic(x[~calibration], t, _balanced(t)) for x in views], h[order][calibration])
    else:
        out = _calibrated(models, [x[calibration] for x in views], y[calibration])
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(out)], pa.binary())})


def _cuts(counts: list, share: float) -> np.ndarray | None:
    """Per view and label the lowest bin of the top ``share`` of the pool."""
    pool = sum(r["n"] for r in counts if r["slot"] < 0)
    found = np.zeros((4, BINS), np.int64)
    for r in counts:
        if r["slot"] >= 0:
            found[r["slot"], r["bin"]] = r["n"]
    if not found.any():
        return None
    above = found[:, ::-1].cumsum(axis=1)[:, ::-1]
    # The bin in which the share is reached counts whole.
    return (above >= max(1, int(share * pool))).sum(axis=1).clip(1).reshape(2, 2) - 1


def fit(sample: DataFrame, rounds: int = 4, share: float = 0.1, sure: float = 0.95) -> dict | None:
    """The fitted model, or None without labels of both classes."""

    def labelled(models):
        given = sample.where("label is not null").repartition(1)
        rows = given.mapInArrow(lambda it: _on_labelled(it, models), "model binary").collect()
        return pickle.loads(rows[0]["model"]) if rows else None

    first = labelled(None)
    if first is None:
        return None
    models, calibration = first
    steps: list = []
    for _ in range(rounds):
        m, before = models, list(steps)
        counts = (
            sample.mapInArrow(lambda it: _counted(it, m, before, sure), "slot int, bin int, n long")  # noqa: B023
            .groupBy("slot", "bin")
            .agg(F.sum("n").alias("n"))
            .collect()
        )
        cuts = _cuts(counts, share)
        if cuts is None:
            break
        steps.append((models, cuts))
        now = list(steps)
        parts = sample.mapInArrow(
            lambda it: _part_models(it, calibration, now, sure),  # noqa: B023
            "view int, weight double, c array<double>",
        )
        mean = (
            parts.select("view", "weight", F.posexplode("c").alias("at", "x"))
            .groupBy("view", "at")
            .agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x"))
            .collect()
        )
        models = [
            np.array([r["x"] for r in sorted((r for r in mean if r["view"] == v), key=lambda r: r["at"])], np.float32)
            for v in (0, 1)
        ]
    return labelled(models)


def _scored(batches, model: dict | None) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = b.num_rows
        if model is None or not n:
            parts = [np.full(n, 0.5)] * 3
        else:
            rows = zip(*(b.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars")))
            content, meta = zip(*(_views(r) for r in rows))
            parts = _scores(model, np.stack(content), np.stack(meta))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(p, pa.float64()) for p in parts]],
            ["doc_id", "content_score", "metadata_score", "score"],
        )


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, content_score, metadata_score, score`` of every document.

    Scores are probabilities of label 1.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long")
    )
    kind = dict(base.dtypes)["doc_id"]
    return base.mapInArrow(
        lambda it: _scored(it, model),
        f"doc_id {kind}, content_score double, metadata_score double, score double",
    )
