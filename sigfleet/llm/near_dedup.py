"""Near-duplicates: BagMinHash, banding, exact verification, components.

1. Every text gets a digest of its normal form (lower-cased words, single
   blanks) and a BagMinHash signature of its multiset of word 5-grams
   (:mod:`sigfleet.llm.bagminhash`). Equal digests are one text from here on.
2. Texts that agree in a whole band are candidates. Each bucket links its
   members to its smallest member (a star, not all pairs); links with clearly
   differing signatures are dropped, the others are verified on the exact
   multisets: weighted Jaccard of at least ``threshold``.
3. A bucket whose members still lie in several components draws further
   leads by hash, others in every band. Members that no lead reached are
   then compared with all members of their buckets, chunk against block:
   every pair across components whose signatures are close is verified in the
   task, so no link found by the bands is lost to the stars.
4. Classes are the connected components of the verified links.

Memory is bounded everywhere: star links are verified in chunks of
``CHUNK`` texts, buckets are compared in blocks of ``BLOCK`` signatures.
Hot buckets are split by both.

Defined cases: a null text or one without words is a class of its own (one
class per row); a text of fewer than five words is one gram; repeated rows
are copies; the class id is the smallest ``doc_id`` of the class, null if all
are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigfleet.llm import bagminhash as bmh
from sigfleet.llm.common import packed_row, stored, text_key, unpacked
from sigfleet.llm.components import components
from sigfleet.llm.groups import grouped

BANDS, ROWS = 18, 5
CHUNK = 128
BLOCK = 256
# Signatures of BANDS * ROWS components estimate a similarity with a standard
# deviation of 0.042 at 0.8: a pair is dropped unverified only when its
# estimate lies more than four of these below the threshold, which happens to
# 3 of 100,000 pairs at 0.8 (binomial tail) and to fewer above.
SLACK = 0.18
# Further leads drawn per bucket and band.
LEADS = 3


def _signatures(batches, bands: int, rows: int):
    m = bands * rows
    shingler = bmh.Shingler()
    for batch in batches:
        texts = batch.column("text")
        keys, sigs, digests = [], [], []
        for x in texts:
            words = bmh.normal_words(x.as_py())
            if not words:
                keys.append(None), sigs.append(None), digests.append(None)
                continue
            sig = bmh.signature(*bmh.bag(shingler.hashes(words)), m)
            keys.append(bmh.band_keys(sig, rows).view(np.int64))
            sigs.append(sig.astype(np.uint16).tobytes())
            digests.append(hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest())
        d = [np.frombuffer(x, np.int64) if x else (None, None) for x in digests]
        yield pa.RecordBatch.from_pydict(
            {
                "row": batch.column("row"),
                "doc_id": batch.column("doc_id"),
                "ka": batch.column("ka"),
                "kb": batch.column("kb"),
                "da": pa.array([x[0] for x in d], pa.int64()),
                "db": pa.array([x[1] for x in d], pa.int64()),
                "bands": pa.array(keys, pa.list_(pa.int64())),
                "sig": pa.array(sigs, pa.binary()),
            }
        )


def signatures(
    spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int
) -> DataFrame:
    """Stored ``row, doc_id, ka, kb, da, db, bands, sig``, one row per document."""
    key = text_key(F.col(text_col))
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        key["a"].alias("ka"),
        key["b"].alias("kb"),
        F.col(text_col).alias("text"),
    )
    return stored(
        spark,
        base.mapInArrow(
            lambda it: _signatures(it, bands, rows),
            "row long, doc_id long, ka long, kb long, da long, db long, "
            "bands array<long>, sig binary",
        ),
        "dedup-signatures",
    )


def _verify(groups: Iterator[pa.Table], threshold: float) -> Iterator[pa.RecordBatch]:
    """Similarity of each member of a chunk to the chunk's lead."""
    shingler = bmh.Shingler()
    for g in groups:
        lead = None
        members: dict[int, tuple] = {}
        lead_id = g.column("lead")[0].as_py()
        for i, t in zip(g.column("id").to_pylist(), g.column("text"), strict=True):
            if i == lead_id:
                lead = bmh.bag(shingler.hashes(bmh.normal_words(t.as_py())))
            elif i not in members:
                members[i] = bmh.bag(shingler.hashes(bmh.normal_words(t.as_py())))
        near = [i for i, b in members.items() if bmh.similarity(b, lead) >= threshold]
        if near:
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array(near, pa.int64()),
                    "b": pa.array([lead_id] * len(near), pa.int64()),
                }
            )


def _verified(
    spark: SparkSession, pairs: DataFrame, texts: DataFrame, threshold: float
) -> DataFrame:
    """Of ``pairs(id, lead, n)`` those at or above the threshold, as ``a, b``.

    A lead with many members is dealt to chunks; its text is repeated once
    per chunk, not once per pair. ``n`` is the size of the largest bucket
    that made the pair: a lead stands in one bucket per band, so a chunk
    holds at most ``CHUNK`` pairs of each band or thereabouts.
    """
    chunks = F.ceil(F.col("n") / CHUNK)
    dealt = pairs.select("lead", "id", F.pmod(F.xxhash64("id"), chunks).cast("int").alias("chunk"))
    leads = dealt.select("lead", "chunk").distinct().withColumn("id", F.col("lead"))
    rows = dealt.unionByName(leads).join(texts, "id").select("lead", "chunk", "id", "text")
    return stored(
        spark,
        grouped(rows, ["lead", "chunk"], lambda g: _verify(g, threshold), "a long, b long"),
        "dedup-links",
    )


def _linked(
    groups: Iterator[pa.Table], threshold: float, rows: int
) -> Iterator[pa.RecordBatch]:
    """Verified links of a chunk of stragglers and a block of members.

    A pair that shares several bands is looked at in the first of them only:
    the band keys tell, or without these the signatures. Components that a
    link has joined here need no second link.
    """
    shingler = bmh.Shingler()
    for g in groups:
        ids = g.column("id").to_numpy()
        side = g.column("side").to_numpy()
        band = g.column("band")[0].as_py()
        texts = g.column("text")
        sig = np.stack([np.frombuffer(x, np.uint16) for x in g.column("sig").to_pylist()])
        if "bands" in g.column_names:
            bands = np.array(g.column("bands").to_pylist(), np.int64)[:, :, None]
        else:
            bands = sig.reshape(len(sig), -1, rows)
        comp = g.column("component").to_numpy().copy()
        bags: dict[int, tuple] = {}

        def bag(i: int, texts=texts, bags=bags) -> tuple:
            if i not in bags:
                bags[i] = bmh.bag(shingler.hashes(bmh.normal_words(texts[i].as_py())))
            return bags[i]

        targets = np.flatnonzero(side == 1)
        out: list[tuple[int, int]] = []
        for k in np.flatnonzero(side == 0):
            other = targets[comp[targets] != comp[k]]
            same = sig[other] == sig[k]
            likely = same.mean(axis=1) >= threshold - SLACK
            other = other[likely]
            if not len(other):
                continue
            shared = (bands[other] == bands[k]).all(axis=2)
            for i in other[shared.argmax(axis=1) == band].tolist():
                if comp[i] != comp[k] and bmh.similarity(bag(int(k)), bag(i)) >= threshold:
                    out.append((max(ids[i], ids[k]), min(ids[i], ids[k])))
                    comp[comp == comp[i]] = comp[k]
        if out:
            x, y = zip(*out, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())}
            )


def _marked(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    return buckets.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _other_leads(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """Further stars for buckets that still hold several components.

    ``LEADS`` leads per bucket, each the member of smallest hash; every band
    draws others, so a text that its first lead did not reach meets dozens
    of members of its group. Only members of other components are linked.
    """
    marked = _marked(buckets, comps)
    drawn = [
        F.min_by(F.struct("id", "component"), F.xxhash64(F.lit(i), "key", "id"))
        for i in range(LEADS)
    ]
    leads = (
        marked.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.min("component").alias("lo"),
            F.max("component").alias("hi"),
            F.array(*drawn).alias("leads"),
        )
        .where("n >= 3 and lo < hi")
        .select("key", "leads", "n")
    )
    pairs = (
        marked.select("key", "id", "component")
        .join(leads, "key")
        .select("id", "component", "n", F.explode("leads").alias("l"))
        .where("component <> l.component")
    )
    return _once(
        pairs.select(F.greatest("id", "l.id").alias("id"), F.least("id", "l.id").alias("lead"), "n")
    )


def _once(pairs: DataFrame) -> DataFrame:
    """``id, lead, n`` without repeats, dealt by ``id`` as the join that follows wants it."""
    return pairs.repartition("id").groupBy("id", "lead").agg(F.max("n").alias("n"))


def _across(
    spark: SparkSession,
    buckets: DataFrame,
    comps: DataFrame,
    members: DataFrame,
    threshold: float,
    rows: int = ROWS,
) -> DataFrame:
    """Verified links inside buckets that still hold several components.

    ``buckets(key, band, id)``, ``members(id, sig, text)``, with ``bands`` or
    without: the members outside a bucket's largest component, in chunks, meet all its members, in
    blocks of ``BLOCK``, and are verified where they meet, so only links
    leave a task.
    """
    marked = _marked(buckets, comps)
    open_keys = (
        marked.groupBy("key", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(
            F.sum("n").alias("all"),
            F.max(F.struct("n", "component")).alias("main"),
        )
        .where("all >= 3 and main.n < all")
        .select(
            "key",
            F.col("main.component").alias("main"),
            F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"),
            F.ceil((F.col("all") - F.col("main.n")) / BLOCK).cast("int").alias("chunks"),
        )
    )
    inside = marked.join(open_keys, "key")
    place = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = inside.select(
        "key", "band", "id", "component", place("blocks").alias("i"),
        F.explode(every("chunks")).alias("j"), F.lit(1).alias("side"),
    )
    stragglers = inside.where("component <> main").select(
        "key", "band", "id", "component", F.explode(every("blocks")).alias("i"),
        place("chunks").alias("j"), F.lit(0).alias("side"),
    )
    return stored(
        spark,
        grouped(
            block.unionByName(stragglers).join(members, "id"),
            ["key", "i", "j"],
            lambda g: _linked(g, threshold, rows),
            "a long, b long",
        ),
        "dedup-links",
    )


def classes(
    spark: SparkSession,
    docs: DataFrame,
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``row, doc_id, ka, kb, class_id, class_size, class_row`` per document.

    ``class_row`` is the row number of the document that stands for its class
    (smallest ``doc_id``, then smallest row number).
    """
    least = threshold - SLACK
    table = signatures(spark, docs, id_col, text_col, bands, rows)
    # Equal texts: one row per text, that of its smallest row number.
    first = F.min(F.struct("row", "doc_id", "ka", "kb", "bands", "sig"))
    copies = stored(
        spark,
        table.where("da is not null")
        .groupBy("da", "db")
        .agg(first.alias("f"))
        .select("da", "db", F.col("f.row").alias("id"), "f.doc_id", "f.ka", "f.kb", "f.bands", "f.sig"),
        "dedup-texts",
    )
    keyed = copies.select("id", F.posexplode("bands").alias("band", "key"))
    leads = (
        keyed.groupBy("key")
        .agg(F.min("id").alias("lead"), F.count("*").alias("n"))
        .where("n > 1")
        .select("key", "lead", "n")
    )
    buckets = stored(
        spark, keyed.join(leads, "key").select("key", "band", "id", "lead", "n"), "dedup-buckets"
    )

    sigs = stored(
        spark,
        copies.select("id", "sig", "bands", "doc_id", "ka", "kb").join(
            buckets.select("id").distinct(), "id", "left_semi"
        ),
        "dedup-members",
    )
    sig = sigs.select("id", "sig")
    star = _once(buckets.where("id <> lead"))
    texts = _texts(spark, docs, sigs.select("id", "doc_id", "ka", "kb"), id_col, text_col)

    def verified(pairs: DataFrame) -> DataFrame:
        close = stored(spark, _plausible(pairs.join(sig, "id"), sig, least), "dedup-candidates")
        return _verified(spark, close, texts, threshold)

    def joined(comps: DataFrame, links: DataFrame) -> DataFrame:
        stars = comps.select(F.col("id").alias("a"), F.col("component").alias("b"))
        return components(spark, stars.unionByName(links))

    comps = components(spark, verified(star))
    comps = joined(comps, verified(_other_leads(buckets, comps)))
    members = sigs.select("id", "sig", "bands").join(texts, "id")
    more = _across(spark, buckets, comps, members, threshold, rows)
    if not more.isEmpty():
        comps = joined(comps, more)

    text_class = copies.join(comps, "id", "left").select(
        "da", "db", F.coalesce("component", "id").alias("class")
    )
    rows_ = table.select("row", "doc_id", "ka", "kb", "da", "db")
    placed = (
        rows_.join(text_class, ["da", "db"], "left")
        .select("row", "doc_id", "ka", "kb", F.coalesce("class", "row").alias("class"))
    )
    heads = placed.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("head"),
        F.count("*").alias("class_size"),
    )
    return placed.join(heads, "class").select(
        "row", "doc_id", "ka", "kb",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        F.col("head.row").alias("class_row"),
    )


def _plausible(pairs: DataFrame, sig: DataFrame, least: float) -> DataFrame:
    """``id, lead, n`` of the pairs whose signatures agree in enough components."""

    def keep(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1)
                for c in ("sig", "other")
            )
            ok = pa.array((x == y).mean(axis=1) >= least)
            names = ["id", "lead", "n"]
            yield pa.RecordBatch.from_arrays([b.column(c).filter(ok) for c in names], names)

    other = sig.select(F.col("id").alias("lead"), F.col("sig").alias("other"))
    return pairs.join(other, "lead").select("id", "lead", "n", "sig", "other").mapInArrow(
        keep, "id long, lead long, n long"
    )


def _texts(
    spark: SparkSession, docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str
) -> DataFrame:
    """Stored ``id, text`` of the wanted ``(id, doc_id, ka, kb)``."""
    key = text_key(F.col(text_col))
    whole = docs.select(
        F.col(id_col).cast("long").alias("doc"),
        F.col(text_col).alias("text"),
        key["a"].alias("ka"),
        key["b"].alias("kb"),
    )
    same: Column = F.expr("doc <=> w.doc_id and t.ka = w.ka and t.kb = w.kb")
    return stored(
        spark,
        whole.alias("t").join(wanted.alias("w"), same).select("id", "text"),
        "dedup-texts-wanted",
    )


def dedup_documents(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how
) -> DataFrame:
    """``docs`` with one document of each class: the one of smallest id."""
    placed = classes(spark, docs, id_col=id_col, text_col=text_col, **how)
    kept = placed.where("row = class_row").select("doc_id", "ka", "kb")
    key = text_key(F.col(text_col))
    packed = docs.select(
        F.col(id_col).cast("long").alias("doc"),
        key["a"].alias("ka"),
        key["b"].alias("kb"),
        packed_row(docs).alias("whole_row"),
    )
    # Rows that agree in id and text are interchangeable: as many stay as were kept.
    counted = kept.groupBy("doc_id", "ka", "kb").agg(F.count("*").alias("stay"))
    same = F.expr("doc <=> k.doc_id and t.ka = k.ka and t.kb = k.kb")
    nth = F.row_number().over(Window.partitionBy("t.ka", "t.kb", "doc").orderBy("t.ka"))
    return (
        packed.alias("t")
        .join(counted.alias("k"), same)
        .select("whole_row", "stay", nth.alias("nth"))
        .where("nth <= stay")
        .select(*unpacked("whole_row", docs.columns))
    )
