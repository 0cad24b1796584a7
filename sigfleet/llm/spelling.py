"""Spelling variants: words one edit apart, grouped under their commonest form.

Words are counted over the whole corpus. Two words are near when one code
point inserted, deleted or replaced turns one into the other. Candidates meet
in dense tiles: the words of a block are a padded matrix of code points,
pairs of blocks are compared column by column, and the lengths of the common
prefix and suffix tell a single edit: together at least the longer length
minus one.

Which blocks meet is exact. Let the shorter word of a pair have ``s`` code
points: a single edit leaves its first ``s // 2`` or its last ``s - s // 2``
code points in place. So every word joins four groups, by its first and by
its last part for ``s`` its own length and one less; a pair is taken in the
group of its common first part, else in that of its last. A group is cut into
blocks of bounded size and every pair of blocks is a tile of its own, so a
large group becomes many tasks and no pair is lost.

Forms (the commonest near word, if at least twice as common) are followed to
their root by pointer doubling.

Defined cases: a null text has no words; a null document id counts as an
empty one; repeated rows count again; an empty table gives an empty result;
other columns are ignored; bytes that are not UTF-8 separate words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.llm.common import stored

# What a run of letters is and which letters are lower-cased.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# One run in ``SLIP`` of a document loses a code point.
SLIP = 97

MIN_LENGTH, MIN_COUNT = 5, 3
# Words and code points of a block at most (one word at least).
BLOCK, CELLS = 512, 1 << 16
# Words that a task counts before it passes them on.
HELD = 400_000


def slipped(run: str, prefix: int) -> str:
    """``run`` as it counts: short of a code point if its hash says so.

    ``prefix`` is the crc32 of what stands before the run in the hashed text.
    """
    h = zlib.crc32(run.encode(), prefix)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches, min_length: int) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_pydict(
            {
                "word": pa.array(list(total.keys()), pa.string()),
                "n": pa.array(list(total.values()), pa.int64()),
            }
        )
        total.clear()
        return b

    for b in batches:
        for i, text in zip(b.column("doc_id"), b.column("text"), strict=True):
            raw = text.as_py()
            if not raw:
                continue
            doc = i.as_py()
            prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for run, n in Counter(RUN.findall(raw.translate(LOWER).decode("utf-8", "replace"))).items():
                if len(run) >= min_length:
                    word = slipped(run, prefix)
                    if len(word) >= min_length:
                        total[word] += n
            if len(total) >= HELD:
                yield out()
    if total:
        yield out()


def word_counts(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """``word, n`` of the words of ``docs(doc_id, text)`` that are long and common enough."""
    counted = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(lambda it: _counted(it, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, code points padded with 0, and the same from the last one backwards."""
    n = np.array([len(w) for w in words])
    width = int(n.max())
    ahead = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
    at = n[:, None] - 1 - np.arange(width)
    back = np.where(at >= 0, np.take_along_axis(ahead, np.maximum(at, 0), 1), 0)
    return n, ahead, back


def _common(a: np.ndarray, b: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Length of the common prefix of rows of ``a`` and ``b``, broadcast to ``shape``."""
    run = np.ones(shape, bool)
    n = np.zeros(shape, np.int32)
    for c in range(a.shape[-1]):
        run &= (a[..., c] == b[..., c]) & (a[..., c] != 0)
        if not run.any():
            break
        n += run
    return n


def _near(x: tuple, y: tuple, s: np.ndarray, first: np.ndarray, shape: tuple) -> np.ndarray:
    """Where ``x`` and ``y`` are a single edit apart and belong to this group.

    A group takes the pairs whose shorter word has ``s`` code points, with a
    common first part (``first``) or else without one.
    """
    longer, shorter = np.maximum(x[0], y[0]), np.minimum(x[0], y[0])
    pre = _common(x[1], y[1], shape)
    suf = _common(x[2], y[2], shape)
    edit = (pre + suf >= longer - 1) & (pre < longer) & (longer - shorter <= 1)
    return edit & (shorter == s) & ((pre >= s // 2) == first)


def tile_pairs(words: list[str], side: np.ndarray, s: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs of one tile: block against block.

    ``side`` 0 and 1 are the rows of either block, 2 means a block against itself.
    """
    n, ahead, back = padded(words)
    i = np.flatnonzero(side != 1)
    j = np.flatnonzero(side != 0)
    x = (n[i][:, None], ahead[i][:, None, :], back[i][:, None, :])
    y = (n[j][None, :], ahead[j][None, :, :], back[j][None, :, :])
    a, b = np.nonzero(_near(x, y, s, first, (len(i), len(j))))
    keep = (side[i[a]] != 2) | (i[a] < j[b])
    return i[a][keep], j[b][keep]


def small_pairs(
    words: list[str], starts: np.ndarray, s: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs of many small blocks, each against itself."""
    if not len(starts):
        return np.zeros(0, int), np.zeros(0, int)
    size = np.diff(np.append(starts, len(words)))
    ahead_of = np.repeat(starts + size, size) - 1 - np.arange(len(words))
    i = np.repeat(np.arange(len(words)), ahead_of)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(ahead_of) - ahead_of, ahead_of)
    n, ahead, back = padded(words)
    fit = np.minimum(n[i], n[j]) == s[i]
    i, j = i[fit], j[fit]
    x, y = ((n[k], ahead[k], back[k]) for k in (i, j))
    ok = _near(x, y, s[i], first[i], (len(i),))
    return i[ok], j[ok]


# Blocks below this many words are compared many at a time, if their words are short.
SMALL, SHORT = 48, 64


def _whole(batches, keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of sorted batches, and where each group starts."""

    def cut(t: pa.Table) -> np.ndarray:
        new = np.zeros(max(0, t.num_rows - 1), bool)
        for k in keys:
            c = t.column(k).to_numpy()
            new |= c[1:] != c[:-1]
        return np.append(0, np.flatnonzero(new) + 1)

    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            t = pa.Table.from_batches([*held, b]).combine_chunks()
            at = cut(t)
            if len(at) > 1:
                yield t.slice(0, at[-1]), at[:-1]
            held = t.slice(at[-1]).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield t, cut(t)


def _tiles(batches) -> Iterator[pa.RecordBatch]:
    """Both directions of the near pairs of every tile."""
    for t, starts in _whole(batches, ["key", "i", "j"]):
        word = t.column("word").to_numpy(zero_copy_only=False)
        n, s, side, part = (t.column(c).to_numpy() for c in ("n", "s", "side", "part"))
        size = np.diff(np.append(starts, len(word)))
        small = (size < SMALL) & (side[starts] == 2) & (s[starts] < SHORT)
        found = []
        for a, m in zip(starts[~small], size[~small], strict=True):
            i, j = tile_pairs(word[a : a + m].tolist(), side[a : a + m], s[a], part[a] == 0)
            found.append((i + a, j + a))
        rows = np.flatnonzero(np.repeat(small & (size > 1), size))
        kept = size[small & (size > 1)]
        i, j = small_pairs(word[rows].tolist(), np.cumsum(kept) - kept, s[rows], part[rows] == 0)
        found.append((rows[i], rows[j]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(a):
            one, two = np.append(a, b), np.append(b, a)
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array(word[one], pa.string()),
                    "near": pa.array(word[two], pa.string()),
                    "n": pa.array(n[one], pa.int64()),
                    "near_n": pa.array(n[two], pa.int64()),
                }
            )


def near_words(spark: SparkSession, words: DataFrame) -> DataFrame:
    """``word, near, n, near_n``: both directions of every near pair of ``words(word, n)``."""
    length = F.length("word")
    lengths = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("s")).where("s > 0")
    parts = F.array(
        F.struct(F.lit(0).alias("part"), F.expr("left(word, int(floor(s / 2)))").alias("key")),
        F.struct(F.lit(1).alias("part"), F.expr("right(word, s - int(floor(s / 2)))").alias("key")),
    )
    keyed = lengths.select("word", "n", "s", F.explode(parts).alias("p")).select(
        "word", "n", "s", F.col("p.part").alias("part"),
        F.xxhash64("s", "p.part", "p.key").alias("key"),
    )
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(CELLS / F.max("s")))).cast("long")
    large = (
        keyed.groupBy("key")
        .agg(F.count("*").alias("size"), block.alias("block"))
        .where("size > block")
        .select("key", F.ceil(F.col("size") / F.col("block")).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = (
        keyed.join(large, "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key", "part", "s", "word", "n",
            F.least("mine", "other").alias("i"),
            F.greatest("mine", "other").alias("j"),
            F.expr("CASE WHEN mine = other THEN 2 WHEN mine < other THEN 0 ELSE 1 END").alias("side"),
        )
    )
    tiles = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return stored(
        spark,
        tiles.mapInArrow(_tiles, "word string, near string, n long, near_n long"),
        "spelling-links",
    )


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root``: where the ``form`` pointers of ``forms(word, form)`` end.

    Pointer doubling: after ``k`` steps a pointer spans ``2 ** k`` forms. Each
    form is at least twice as common, so six steps span every chain of counts
    below 2 ** 63; it ends as soon as no pointer moves.
    """
    at = stored(spark, forms.select("word", F.coalesce("form", "word").alias("root")), "spelling-roots")
    for _ in range(6):
        moving = at.where("word <> root")
        hop = moving.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if moving.join(hop, "root", "left_semi").isEmpty():
            break
        at = stored(
            spark,
            at.join(hop, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
            "spelling-roots",
        )
    return at


def variants(spark: SparkSession, words: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words(word, n)``."""
    words = stored(spark, words, "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = (
        near_words(spark, words)
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), best.alias("best"))
    )
    common = -F.col("best.minus") >= ratio * F.col("n")
    placed = stored(
        spark,
        words.join(near, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.near")).alias("form"),
            F.when(common, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    return placed.join(roots(spark, placed), "word").select(
        "word", "form", "root", "n", "n_near", "form_n"
    )
