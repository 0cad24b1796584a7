"""Near-dedup, top-k and the numpy cores against brute force."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sigfleet.llm import bagminhash as bmh
from sigfleet.llm import components, groups, near_dedup, topk
from sigfleet.llm.mtree import MTree, lift
from tests.llm import data


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    off = []
    for _ in range(40):
        e = np.unique(rng.integers(0, 2**63, int(rng.integers(3, 300))).astype(np.uint64))
        a = rng.integers(1, 9, len(e))
        b = np.maximum(0, a + rng.integers(-3, 4, len(e)))
        k = b > 0
        j = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        same = (bmh.signature(e, a, 512) == bmh.signature(e[k], b[k], 512)).mean()
        off.append((same - j) / np.sqrt(j * (1 - j) / 512 + 1e-9))
    assert abs(np.mean(off)) < 0.6 and np.std(off) < 1.5


def test_similarity_counts_multiplicity():
    bag = lambda xs: bmh.bag(np.array(xs, np.uint64))
    assert bmh.similarity(bag([1, 1, 1, 2]), bag([1, 2, 2])) == 2 / 5
    assert bmh.similarity(bag([]), bag([])) == 0.0


def test_shingles():
    s = bmh.Shingler()
    words = "a b c d e f a b c d e".split()
    h = s.hashes(words)
    assert len(h) == 7 and h[0] == h[6] and len(set(h.tolist())) == 6
    assert len(s.hashes(["a"])) == 1 and len(s.hashes([])) == 0
    assert s.hashes(["ab", "c"])[0] != s.hashes(["a", "bc"])[0]


def brute_classes(rows, threshold=0.8):
    """Class of each row by comparing all pairs (small tables only)."""
    s = bmh.Shingler()
    words = [bmh.normal_words(t) for _, t in rows]
    bags = [bmh.bag(s.hashes(w)) for w in words]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if words[i] and bmh.similarity(bags[i], bags[j]) >= threshold:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    size = Counter(find(i) for i in range(len(rows)))
    return Counter((doc, least.get(find(i)), size[find(i)]) for i, (doc, _) in enumerate(rows))


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [data.sentence(rng, 80, 10_000) for _ in range(15)]
    texts += near_copies(rng, texts[0], 40, 1)  # most pairs above, some below the threshold
    texts += near_copies(rng, texts[1], 10, 8)  # all below
    chain = texts[2]
    for _ in range(6):  # each like the one before, the ends unlike
        chain = near_copies(rng, chain, 1, 1)[0]
        texts.append(chain)
    texts += ["short text", "Short  TEXT", "b " * 50, "b " * 60, "b " * 90]
    df, rows = data.messy(spark)
    rows = [(r[0], r[1]) for r in rows] + [(100 + i, t) for i, t in enumerate(texts)]
    both = df.select("doc_id", "text").unionByName(
        spark.createDataFrame(rows[-len(texts):], "doc_id long, text string")
    )
    got = near_dedup.classes(spark, both)
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got.collect()) == brute_classes(rows)


def test_links_beyond_the_star_are_found(spark):
    """Members that no lead reached are compared across components."""
    rng = random.Random(12)
    base = data.sentence(rng, 60, 10_000)
    texts = {5: data.sentence(rng, 60, 10_000), 6: base, 7: near_copies(rng, base, 1, 1)[0]}
    pairs = spark.createDataFrame([(1, 0, 5), (1, 0, 6), (1, 0, 7)], "key long, band int, id long")
    sig = np.arange(90, dtype=np.uint16)
    far = sig.copy()
    far[5:] += 1000
    members = spark.createDataFrame(
        [(i, bytearray((far if i == 5 else sig).tobytes()), t) for i, t in texts.items()],
        "id long, sig binary, text string",
    )
    none = spark.createDataFrame([], "id long, component long")
    found = near_dedup._across(spark, pairs, none, members, 0.8).collect()
    assert {(r.a, r.b) for r in found} == {(7, 6)}
    later = near_dedup._across(spark, pairs.withColumn("band", F.lit(3)), none, members, 0.8)
    assert later.isEmpty()  # a pair is looked at in the first band it shares


def test_recall_on_a_given_table(spark, record_property):
    """Documents whose id 50 divides, against all rows of sf0.1, by exact similarity."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    class_of = {r.doc_id: r.class_id for r in near_dedup.classes(spark, docs).collect()}
    s = bmh.Shingler()
    bags = {r.doc_id: Counter(s.hashes(bmh.normal_words(r.text)).tolist()) for r in docs.collect()}
    assert len(class_of) == len(bags)
    total = {d: sum(b.values()) for d, b in bags.items()}
    holders = {}
    for d, b in bags.items():
        for h, n in b.items():
            holders.setdefault(h, []).append((d, n))
    pairs = together = 0
    for q in (d for d in bags if d % 50 == 0):
        common = Counter()
        for h, n in bags[q].items():
            for d, m in holders[h]:
                common[d] += min(n, m)
        for d, c in common.items():
            if d != q and c >= 0.8 * (total[q] + total[d] - c):
                pairs += 1
                together += class_of[q] == class_of[d]
    record_property("pairs", pairs)
    record_property("together", together)
    print(f"recall: {together} of {pairs} pairs")
    assert pairs and together >= 0.99 * pairs
    # Nothing but classes of linked documents: a class of one has no partner.
    size = Counter(class_of.values())
    assert all(size[class_of[d]] > 1 or class_of[d] == d for d in class_of)


def test_dedup_documents(spark):
    df, rows = data.messy(spark)
    out = near_dedup.dedup_documents(spark, df)
    assert out.columns == df.columns
    ids = Counter(r.doc_id for r in out.collect())
    # 1, 1, 2 and 3 are one class; texts without words stay, each for itself.
    assert ids == Counter({1: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 1, None: 2})
    assert near_dedup.dedup_documents(spark, data.empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    df = spark.createDataFrame(links, "a long, b long")
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = {r.id: r.component for r in components.components(spark, df).collect()}
    assert got == {x: find(x) for x in linked}
    assert components.components(spark, df.limit(0)).count() == 0


def test_grouped_streams_whole_groups(spark):
    import pyarrow as pa

    df = spark.range(10_000).selectExpr("id % 37 as k", "id as v")

    def sizes(tables):
        for t in tables:
            assert len(set(t.column("k").to_pylist())) == 1
            yield pa.RecordBatch.from_pydict(
                {"k": pa.array([t.column("k")[0].as_py()]), "n": pa.array([t.num_rows])}
            )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = sorted(tuple(r) for r in groups.grouped(df, ["k"], sizes, "k long, n long").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(k, 10_000 // 37 + (k < 10_000 % 37)) for k in range(37)]


def brute_top(rows, k=10, scale=1024):
    good = [
        (i, [int(np.floor(scale * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = Counter()
    for n, (q, a) in enumerate(good):
        if q % 100:
            continue
        scores = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(good) if m != n
        )
        for rank, (s, i) in enumerate(scores[:k], 1):
            out[(q, rank, i, -s)] += 1
    return out


def top(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.selectExpr("*", "1 as row", "2 as cell", "3 as block")
    got = topk.top_k(spark, df, F.col("vec_id") % 100 == 0)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return Counter(tuple(r) for r in got.collect())


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 1, (6, 12))
    rows = []
    for i in range(900):
        v = (centers[i % 6] + rng.normal(0, 0.1, 12)) * rng.uniform(0.2, 3)
        rows.append((i, [float(x) for x in np.round(v, 2)], 0))
    rows += [(1000 + i, rows[5][1], 0) for i in range(30)]  # ties
    rows += [(100, rows[7][1], 0), (100, rows[7][1], 0), (-200, [0.0] * 12, 0)]  # repeated ids
    rows += [(2000, None, 0), (2001, [1.0, None], 0), (2100, [float("nan")] * 12, 0),
             (2200, [float("inf")] * 12, 0), (None, rows[0][1], 0), (2300, [], 0), (2400, [5.0], 0)]
    assert top(spark, rows) == brute_top([r[:2] for r in rows])


def test_top_k_few_and_none(spark):
    assert top(spark, [(100, [1.0], 0), (3, [2.0], 0)]) == Counter([(100, 1, 3, 1024 * 2048)])
    assert top(spark, [(0, [1.0], 0)]) == Counter()
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(spark, df, F.col("vec_id") % 100 == 0).count() == 0


def test_mtree_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    centers = rng.integers(-4000, 4000, (40, 8))
    x = (centers[rng.integers(0, 40, 5000)] + rng.integers(-20, 20, (5000, 8))).astype(np.int64)
    r2 = float((x.astype(float) ** 2).sum(axis=1).max())
    tree = MTree(x, np.arange(5000), r2)
    lifted = lift(x, r2)
    for p in tree.pages:  # every entry lies within its page's stored bounds
        if not p.leaf:
            for child, radius, at in zip(p.members, p.radii, p.points, strict=True):
                sub = tree.pages[child]
                if sub.leaf:
                    d = np.sqrt(((lifted[sub.members] - at) ** 2).sum(axis=1))
                    assert (d <= radius + 1e-6).all() and np.allclose(d, sub.to_parent)
    for q in x[:25]:
        s = x @ q
        want = sorted(zip((-s).tolist(), range(5000)))[:10]
        assert [(a, b) for a, b, _ in tree.search(q, (), 10, r2, None)] == want
