"""Phrase collocations: frequent phrases of two to five words per language.

Phrases are counted in a HAT-trie per task: a shallow trie over word ids whose
leaves are hash containers of the remaining ids. A container that grows too
large bursts into a trie node with a container per next word. When a task
holds too many phrases it spills whole subtrees, the largest first, as sorted
runs; the runs of a prefix meet in one partition and are merged there.

Most phrases are rare, and none that is rarer than ``min_count`` (in its
language) can be a candidate or hold one. Two passes before the trie find out
which can: the hashes of all words and word pairs, then those of longer
phrases made of frequent pairs only, are counted as sorted, delta-coded runs
and merged by hash prefix. Hashes of ``BITS`` bits may coincide, which only
lets a rare phrase through; the trie then counts what is left exactly, by
its words. What travels to the tasks is a bitmap per length of at most
2 ** ``MAP_BITS`` bits: a corpus that fills it is counted as exactly, with more
phrases in the trie.

A candidate's score is that of its lowest cut. A candidate is dropped if a
longer one holds it equally often; one word more is enough to look at, for a
phrase in between is as frequent as both. Scores are decimals of 38 digits.

Defined cases: a null text is empty; a null language is ``und``; repeated
rows count again; a corpus without candidates gives an empty result; other
columns are ignored; texts are compared as bytes, so that invalid UTF-8 is
counted like any other word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.llm.common import stored
from sigfleet.llm.groups import grouped

# What ends a piece, what separates words, which letters are lower-cased.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LONGEST = 5
MIN_COUNT = 100
TOP = 2000

# Bits of a phrase hash in the passes before the trie.
BITS = 40
# Bits of a bitmap of frequent hashes at most (16 MB).
MAP_BITS = 27
# Bytes of text looked at together (one text at least).
CHUNK = 4 << 20
# Hashes that a task holds before it writes runs.
RUN = 4 << 20
# Bytes of text per part of the hashes, and bits of the number of parts at most: a
# run of RUN hashes is cut into pieces of no fewer than 16.
SHARE, PART_BITS = 1 << 20, 18
# Phrases in a container before it bursts, levels of trie nodes, phrases in a trie before it spills.
BURST, LEVELS, HELD = 2_048, 3, 400_000

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[list(UPPER)] += 32


class Chunk:
    """The words of some texts: ids into ``names``, piece and row of each."""

    def __init__(self, text: pa.Array):
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = text.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        kind = _KIND[raw]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        rows = offsets[:-1][offsets[:-1] < len(raw)]
        begins[rows] = inside[rows]
        at = np.flatnonzero(begins)
        length = np.add.reduceat(inside, at, dtype=np.int64) if len(at) else at
        stops = np.append(0, np.cumsum(length))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(stops), pa.py_buffer(_LOWER[raw[inside]])]
        ).dictionary_encode()
        self.names: list[bytes] = words.dictionary.to_pylist()
        self.ids = words.indices.to_numpy().astype(np.int64)
        ends = kind == 2
        ends[rows] = True
        self.piece = np.cumsum(ends)[at]
        self.row = np.searchsorted(offsets, at, "right") - 1

    def windows(self, k: int) -> np.ndarray:
        """Whether ``k`` words of one piece start at each word."""
        ok = np.zeros(len(self.ids), bool)
        if len(ok) >= k:
            ok[: len(ok) - k + 1] = self.piece[k - 1 :] == self.piece[: len(ok) - k + 1]
        return ok


def chunks(batches) -> Iterator[tuple[list[bytes], np.ndarray, Chunk]]:
    """Languages, the language of each row, and the words of a few texts at a time."""
    for b in batches:
        if not b.num_rows:
            continue
        text = b.column("text").cast(pa.large_binary())
        lang = b.column("lang").cast(pa.large_binary()).dictionary_encode()
        names, codes = lang.dictionary.to_pylist(), lang.indices.to_numpy()
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        a = 0
        while a < len(text):
            z = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, "right")) - 1)
            yield names, codes[a:z], Chunk(text.slice(a, z - a))
            a = z


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def phrase_hashes(langs: list[bytes], codes: np.ndarray, c: Chunk, longest: int) -> list[np.ndarray]:
    """Hash of the 1, 2, … words from each word on; right where a window fits."""
    word = np.array([xxhash.xxh3_64_intdigest(w) for w in c.names], np.uint64)[c.ids]
    lang = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in langs], np.uint64)[codes][c.row]
    out = [_mixed(word ^ lang)]
    for k in range(1, longest):
        last = out[-1]
        h = np.zeros_like(last)
        n = len(last) - k
        if n > 0:
            h[:n] = _mixed(last[:n] * np.uint64(0x9E3779B97F4A7C15) + word[k:])
        out.append(h)
    return [h >> np.uint64(64 - BITS) for h in out]


def _planes(x: np.ndarray) -> bytes:
    """Bytes of whole numbers, the lowest bytes of all first: small ones compress well."""
    return x.astype("<u8").view(np.uint8).reshape(len(x), 8).T.tobytes()


def _unplanes(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(x, np.uint8).reshape(8, n).T.copy().view("<u8").ravel()


def encoded_run(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct values and their counts, delta-coded."""
    return _planes(np.diff(values, prepend=np.uint64(0))) + _planes(counts)


def decoded_run(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(run) // 2
    n = half // 8
    return np.cumsum(_unplanes(run[:half], n)), _unplanes(run[half:], n)


def _runs(found: Iterator[dict[int, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    """Runs ``level, part, run`` of the hashes found, by level and hash prefix."""
    held: dict[int, list[np.ndarray]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        shift = np.uint64(BITS - parts.bit_length() + 1)
        for level, lists in held.items():
            v, n = np.unique(np.concatenate(lists), return_counts=True)
            part = v >> shift
            cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(v))
            for a in range(0, len(cuts) - 1, 1024):
                spans = list(zip(cuts[a : a + 1024], cuts[a + 1 : a + 1025], strict=False))
                yield pa.RecordBatch.from_pydict(
                    {
                        "level": pa.array([level] * len(spans), pa.int32()),
                        "part": pa.array([int(part[x]) for x, _ in spans], pa.int64()),
                        "run": pa.array([encoded_run(v[x:y], n[x:y]) for x, y in spans], pa.binary()),
                    }
                )
        held.clear()

    for levels in found:
        for level, h in levels.items():
            if len(h):
                held.setdefault(level, []).append(h)
                size += len(h)
        if size >= RUN:
            yield from out()
            size = 0
    yield from out()


def _merged(groups: Iterator[pa.Table], min_count: int) -> Iterator[pa.RecordBatch]:
    """The hashes of a prefix that are frequent over all of its runs."""
    for g in groups:
        runs = [decoded_run(x) for x in g.column("run").to_pylist()]
        v, n = (np.concatenate(x) for x in zip(*runs, strict=True))
        order = np.argsort(v, kind="stable")
        v, n = v[order], n[order]
        starts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        keep = starts[np.add.reduceat(n, starts) >= min_count]
        if len(keep):
            yield pa.RecordBatch.from_pydict(
                {
                    "level": pa.array([g.column("level")[0].as_py()] * len(keep), pa.int32()),
                    "value": pa.array(v[keep].astype(np.int64), pa.int64()),
                }
            )


def bitmaps(spark: SparkSession, frequent: DataFrame) -> dict[int, np.ndarray]:
    """A bitmap per level over the low bits of its frequent hashes.

    Sixteen bits per hash, 2 ** ``MAP_BITS`` at most.
    """
    sizes = {r["level"]: r["n"] for r in frequent.groupBy("level").agg(F.count("*").alias("n")).collect()}
    bits = {k: min(MAP_BITS, max(10, (16 * n - 1).bit_length())) for k, n in sizes.items()}
    if not bits:
        return {}
    low = F.expr(
        "value & CASE level " + " ".join(f"WHEN {k} THEN {2**b - 1}" for k, b in bits.items()) + " END"
    )
    cells = (
        frequent.select("level", low.alias("at"))
        .groupBy("level", F.shiftright("at", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("set"))
        .toArrow()
    )
    level, cell, value = (cells.column(c).to_numpy() for c in ("level", "cell", "set"))
    out = {}
    for k, b in bits.items():
        m = np.zeros(2 ** (b - 6), np.uint64)
        m[cell[level == k]] = value[level == k].astype(np.uint64)
        out[k] = m
    return out


def hit(bitmap: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Which hashes may be frequent."""
    if bitmap is None:
        return np.zeros(len(h), bool)
    at = h & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _short(batches, parts: int) -> Iterator[pa.RecordBatch]:
    """Runs of the hashes of all words and word pairs."""

    def found():
        for langs, codes, c in chunks(batches):
            h = phrase_hashes(langs, codes, c, 2)
            yield {k: h[k - 1][c.windows(k)] for k in (1, 2)}

    return _runs(found(), parts)


def _long(batches, parts: int, maps: dict[int, np.ndarray], longest: int) -> Iterator[pa.RecordBatch]:
    """Runs of the hashes of longer phrases all of whose word pairs are frequent."""

    def found():
        for langs, codes, c in chunks(batches):
            h = phrase_hashes(langs, codes, c, longest)
            pair = c.windows(2) & hit(maps.get(2), h[1])
            ok, out = pair.copy(), {}
            for k in range(3, longest + 1):
                ok[: len(ok) - k + 2] &= pair[k - 2 :]
                ok &= c.windows(k)
                out[k] = h[k - 1][ok]
            yield out

    return _runs(found(), parts)


class HatTrie:
    """Counts of paths of ids: trie nodes (dicts by id) over hash containers.

    A node is ``{id: child}``, a child a node or a container; a container is
    a ``Container`` of remaining paths. Nodes reach ``levels`` deep.
    """

    class Container(dict):
        """Counts by remaining path; the empty path counts what ends here."""

    class Node(dict):
        """Children by id; ``None`` counts what ends here."""

    def __init__(self, burst: int = BURST, levels: int = LEVELS):
        self.burst, self.levels = burst, levels
        self.root = self.Node()
        self.sizes: dict[int, int] = {}  # paths below each child of the root

    def add(self, path: tuple[int, ...], n: int) -> None:
        node, depth = self.root, 0
        while True:
            if depth == len(path):
                if None not in node:
                    self.sizes[path[0]] += 1
                node[None] = node.get(None, 0) + n
                return
            child = node.get(path[depth])
            depth += 1
            if child is None:
                child = node[path[depth - 1]] = self.Container()
                if depth == 1:
                    self.sizes[path[0]] = 0
            if type(child) is self.Container:
                rest = path[depth:]
                if rest not in child:
                    self.sizes[path[0]] += 1
                    child[rest] = n
                    if len(child) > self.burst and depth < self.levels:
                        node[path[depth - 1]] = self._burst(child)
                else:
                    child[rest] += n
                return
            node = child

    def _burst(self, container: Container) -> Node:
        node = self.Node()
        for rest, n in container.items():
            if rest:
                node.setdefault(rest[0], self.Container())[rest[1:]] = n
            else:
                node[None] = n
        return node

    def __len__(self) -> int:
        return sum(self.sizes.values())

    def paths(self, below: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """All paths from a child of the root on, with their counts."""
        todo = [((below,), self.root[below])]
        while todo:
            path, here = todo.pop()
            if type(here) is self.Container:
                for rest, n in here.items():
                    yield path + rest, n
            else:
                for key, child in here.items():
                    if key is None:
                        yield path, child
                    else:
                        todo.append(((*path, key), child))

    def spill(self, keep: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Paths of the largest subtrees, which go, until ``keep`` paths remain."""
        left = len(self)
        for below in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if left <= keep:
                break
            yield from self.paths(below)
            left -= self.sizes.pop(below)
            del self.root[below]


class Numbers:
    """Ids of the words of a task, and one per language and first word.

    The first id of a path tells the language as well, so that subtrees are
    those of first words; its name is the language.
    """

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.names: list[bytes] = []
        self._words: dict[bytes, int] = {}
        self._firsts: dict[tuple[bytes, int], int] = {}

    def _of(self, table: dict, key, name: bytes) -> int:
        i = table.setdefault(key, len(self.names))
        if i == len(self.names):
            self.names.append(name)
        return i

    def path(self, lang: bytes, word: bytes) -> tuple[int, int]:
        i = self._of(self._words, word, word)
        return self._of(self._firsts, (lang, i), lang), i


def _chunk_phrases(
    langs: list[bytes], codes: np.ndarray, c: Chunk, maps: dict[int, np.ndarray], longest: int, numbers: Numbers
) -> Iterator[tuple[list[tuple[int, ...]], list[int]]]:
    """Paths and counts of the phrases of 1, 2, … words that may be frequent."""
    h = phrase_hashes(langs, codes, c, longest)
    d = max(1, len(c.names))
    single = hit(maps.get(1), h[0])
    ok = single
    node = codes[c.row].astype(np.int64)  # a rank per path so far
    ids = np.zeros(d, np.int64)
    paths: list[tuple[int, ...]] = []
    for k in range(1, longest + 1):
        if k > 1:
            ok = ok & c.windows(k) & hit(maps.get(k), h[k - 1])
            ok[: len(ok) - k + 1] &= single[k - 1 :]
        at = np.flatnonzero(ok)
        if not len(at):
            return
        key, rank, n = np.unique(node[at] * d + c.ids[at + k - 1], return_inverse=True, return_counts=True)
        if k == 1:
            words = (key % d).tolist()
            paths = [numbers.path(langs[x], c.names[w]) for x, w in zip((key // d).tolist(), words, strict=True)]
            ids[words] = [p[1] for p in paths]
        else:
            last = ids[key % d].tolist()
            paths = [paths[p] + (w,) for p, w in zip((key // d).tolist(), last, strict=True)]
        node = np.zeros(len(ok), np.int64)
        node[at] = rank
        yield paths, n.tolist()


def _trie_runs(batches, maps: dict[int, np.ndarray], longest: int) -> Iterator[pa.RecordBatch]:
    """Sorted runs ``lang, k, prefix, phrase, n``; ``k`` = 0 counts all words."""
    trie, numbers = HatTrie(), Numbers()
    total: dict[bytes, int] = {}

    def spilled(keep: int) -> Iterator[pa.RecordBatch]:
        names = numbers.names
        rows = sorted(([names[i] for i in p], n) for p, n in trie.spill(keep))
        for a in range(0, len(rows), 10_000):
            part = rows[a : a + 10_000]
            yield _run_batch(
                [p[0] for p, _ in part], [len(p) - 1 for p, _ in part],
                [b" ".join(p[1:3]) for p, _ in part], [b" ".join(p[1:]) for p, _ in part], [n for _, n in part],
            )

    for langs, codes, c in chunks(batches):
        rows = np.bincount(codes[c.row], minlength=len(langs))
        for lang, n in zip(langs, rows.tolist(), strict=True):
            if n:
                total[lang] = total.get(lang, 0) + n
        for paths, counts in _chunk_phrases(langs, codes, c, maps, longest, numbers):
            for p, n in zip(paths, counts, strict=True):
                trie.add(p, n)
        if len(trie) > HELD:
            yield from spilled(HELD // 2)
        if len(numbers.names) > 2 * HELD:
            yield from spilled(0)
            numbers.clear()
    yield from spilled(0)
    yield _run_batch(list(total), [0] * len(total), [b""] * len(total), [b""] * len(total), list(total.values()))


def _run_batch(lang, k, prefix, phrase, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array(lang, pa.binary()),
            "k": pa.array(k, pa.int32()),
            "prefix": pa.array(prefix, pa.binary()),
            "phrase": pa.array(phrase, pa.binary()),
            "n": pa.array(n, pa.int64()),
        }
    )


def phrase_counts(
    spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST
) -> DataFrame:
    """Stored ``lang, k, phrase, n`` of phrases of ``k`` words that occur ``min_count`` times.

    ``k`` = 0 (an empty phrase) counts the words of a language. Words are
    joined by single blanks.
    """
    base = docs.select(
        F.coalesce("lang", F.lit("und")).cast("binary").alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    # The runs of a part, which one task merges at a time, stem from about SHARE bytes of text.
    size = base.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 << min(PART_BITS, int(size / SHARE).bit_length())

    def frequent(step) -> DataFrame:
        runs = base.mapInArrow(step, "level int, part long, run binary")
        merged = grouped(
            runs, ["level", "part"], lambda g: _merged(g, min_count), "level int, value long"
        )
        return stored(spark, merged, "phrase-hashes")

    maps = bitmaps(spark, frequent(lambda it: _short(it, parts)))
    if longest > 2:
        maps |= bitmaps(spark, frequent(lambda it, m=maps: _long(it, parts, m, longest)))
    runs = base.mapInArrow(
        lambda it: _trie_runs(it, maps, longest),
        "lang binary, k int, prefix binary, phrase binary, n long",
    )
    merged = (
        runs.repartition("lang", "prefix")
        .sortWithinPartitions("lang", "prefix", "phrase")
        .groupBy("lang", "prefix", "phrase")
        .agg(F.first("k").alias("k"), F.sum("n").alias("n"))
        .where((F.col("k") == 0) | (F.col("n") >= min_count))
    )
    return stored(
        spark,
        merged.select(
            F.col("lang").cast("string").alias("lang"), "k", F.col("phrase").cast("string").alias("phrase"), "n"
        ),
        "phrase-counts",
    )


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    longest: int = LONGEST,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language."""
    counts = phrase_counts(spark, docs, min_count, longest)
    phrases = counts.where("k > 0").select("lang", "k", "phrase", "n")
    total = counts.where("k = 0").select("lang", F.col("n").alias("total"))
    words = F.split("phrase", " ")
    part = lambda a, n: F.array_join(F.slice(words, a, n), " ")
    k = F.col("k")
    # The longer phrases by one word that hold a phrase.
    holding = (
        phrases.where("k > 2")
        .select("lang", "n", F.explode(F.array(part(F.lit(1), k - 1), part(F.lit(2), k - 1))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("held"))
    )
    alone = (
        phrases.where("k >= 2")
        .join(holding, ["lang", "phrase"], "left")
        .where("held IS NULL OR 100 * held < 100 * n")
    )
    cut = alone.select(
        "lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), k - 1)).alias("cut"), "k"
    ).select(
        "lang", "phrase", "a", "cut",
        part(F.lit(1), F.col("cut")).alias("left"),
        part(F.col("cut") + 1, k - F.col("cut")).alias("right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = (
        cut.join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
        .join(total, "lang")
        .withColumn("above", (1000 * wide("a")) * wide("total"))
        .withColumn("below", wide("l") * wide("r"))
        .withColumn("score", F.expr("above div below"))
    )
    lowest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("low"),
        F.first("a").alias("a"),
        F.first("total").alias("n"),
    ).select("lang", "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each share of a language, then the best of those.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = lowest.withColumn("place", F.row_number().over(share)).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (
        best.withColumn("rank", rank.cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
