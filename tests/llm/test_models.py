"""Token counts, packing, language id, co-training, registration, pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from sigfleet.llm import bigru, cotraining, language_id, packing, queries, token_counts
from sigfleet.llm.common import stored
from tests.conftest import SF_SMOKE
from tests.llm import data

VOCABULARY = queries.VOCABULARY.removeprefix("file://")


def plain_encoder():
    import tiktoken

    with open(VOCABULARY) as f:
        ranks = token_counts._ranks(f.read().splitlines())
    return tiktoken.Encoding(
        "plain", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_token_histogram_and_sums(spark):
    df, rows = data.messy(spark)
    e = plain_encoder()
    lengths = np.array([len(e.encode_ordinary(r[1] or "")) for r in rows])
    sums = token_counts.totals(
        token_counts.histogram(token_counts.lengths(spark, df, queries.VOCABULARY))
    )
    got = {r.length: r for r in sums.collect()}
    assert Counter(lengths.tolist()) == Counter({k: r.n_docs for k, r in got.items()})
    for k, r in got.items():
        assert r.docs_within == (lengths <= k).sum() and r.docs_over == (lengths > k).sum()
        assert r.tokens_within == lengths[lengths <= k].sum()
        assert r.truncated_tokens == np.minimum(lengths, k).sum()
        assert r.quantile == r.docs_within / len(rows)
    for r in token_counts.at_limits(sums, [0, 1, 100, 10**9]).collect():
        assert r.docs_within == (lengths <= r.limit).sum()
        assert r.truncated_tokens == np.minimum(lengths, r.limit).sum()
    none = token_counts.lengths(spark, data.empty(spark), queries.VOCABULARY)
    assert token_counts.totals(token_counts.histogram(none)).count() == 0


def test_shard_takes_the_tightest_compatible_bin():
    rng = random.Random(6)
    shard = packing.Shard(100, 2)
    bins = []  # [residual, clusters, sources], the plain form
    for size in sorted((rng.randrange(1, 100) for _ in range(400)), reverse=True):
        source, cluster = rng.randrange(4), 1 << rng.randrange(60)
        fit = [
            (b[0], i)
            for i, b in enumerate(bins)
            if b[0] >= size and not b[1] & cluster and b[2][source] < 2
        ]
        least = min(fit)[0] if fit else None
        before = list(shard.residuals)
        got = shard.place(size, source, cluster)
        if least is None:
            assert got == len(bins)
            bins.append([100, 0, Counter()])
        else:
            assert before[got] == least
        bins[got][0] -= size
        bins[got][1] |= cluster
        bins[got][2][source] += 1
        assert shard.residuals[got] == bins[got][0]


def test_pack_is_whole_and_keeps_its_constraints(spark):
    rng = random.Random(7)
    df, rows = data.messy(spark)
    more = [
        (100 + i, data.sentence(rng, rng.randrange(1, 120), 10**6), "en", f"s{min(3, i % 9)}", 1)
        for i in range(300)
    ]
    copies = [(600 + i, "the same short text", "en", "s9", 1) for i in range(40)]
    rows = rows + more + copies
    both = df.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(more + copies, data.DOCS)
    )
    out = packing.pack(spark, both, capacity=256, max_per_source=3).collect()
    words = Counter()
    bins = defaultdict(list)
    for r in out:
        words[r.doc_id] += r.n_words
        if r.bin is None:
            assert r.n_words == 0
        else:
            bins[r.bin].append(r)
        assert r.first_word == r.piece * 256 and r.n_words <= 256
    want = Counter()
    for r in rows:
        want[r[0]] += len((r[1] or "").split())
    assert words == want
    text = {r[0]: " ".join((r[1] or "").lower().split()) for r in rows if r[0] is not None}
    for rs in bins.values():
        assert sum(r.n_words for r in rs) <= 256
        assert max(Counter(r.source for r in rs).values()) <= 3
        assert max(Counter(text.get(r.doc_id) for r in rs).values()) == 1
    # Rows that are copies each have bins of their own.
    assert len({r.bin for r in out if r.doc_id in (1, 2, 3)}) == 4
    assert packing.pack(spark, data.empty(spark)).count() == 0
    assert packing.packed_documents(spark, both).select("bin").distinct().count() > 1


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in bigru.new_model(4, 3).items()}
    w = rng.integers(0, 6, (7, 5)).astype(np.uint8)
    y = rng.integers(0, 3, 5)
    used = (rng.random((7, 5)) < 0.8).astype(np.float64)
    _, grad = bigru.gradients(p, w, y, used)
    for k in p:
        for _ in range(4):
            i = tuple(int(rng.integers(0, min(s, 6))) for s in p[k].shape)
            old = p[k][i]
            p[k][i] = old + 1e-3
            up = bigru.gradients(p, w, y, used)[0]
            p[k][i] = old - 1e-3
            down = bigru.gradients(p, w, y, used)[0]
            p[k][i] = old
            assert abs((up - down) / 2e-3 - grad[k][i]) < 1e-3


def test_pooling_covers_whole_texts():
    p = bigru.new_model(4, 3)
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 127, 128, 129, 5000)]
    got = bigru.pooled(p, texts, batch_windows=7)
    for t, row in zip(texts, got, strict=True):
        total = np.zeros(3)
        for a in range(0, len(t), bigru.WINDOW):
            part = t[a : a + bigru.WINDOW].ljust(bigru.WINDOW, b"\0")
            prob = bigru.position_probabilities(p, np.frombuffer(part, np.uint8)[:, None])
            total += prob[: len(t) - a, :, 0].sum(axis=0)
        assert np.allclose(row, total / max(1, len(t)), atol=1e-4)


def test_language_held_out_accuracy_and_cases(spark):
    out = queries.op10_language_id(spark, SF_SMOKE)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{SF_SMOKE}/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.9
    df, raw = data.messy(spark)
    learn = F.col("doc_id") != 9
    fitted = language_id.fit(language_id.training_sample(spark, df, learn))
    got = language_id.predict(df, fitted, keep=["doc_id"]).collect()
    assert len(got) == len(raw)
    for r in got:
        if r.doc_id in (4, 5, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in fitted[0] and 0 <= r.score <= 1
    nothing = language_id.fit(language_id.training_sample(spark, data.empty(spark), F.lit(True)))
    assert nothing is None
    assert {r.lang_pred for r in language_id.predict(df, nothing, keep=["doc_id"]).collect()} == {"und"}


def test_cotraining_uses_the_other_view():
    """Few labels; the metadata view decides what content alone cannot."""
    rng = np.random.default_rng(5)
    n = 1200
    y = rng.integers(0, 2, n)
    content = (rng.normal(0, 1, (n, 30)) + 0.35 * (2 * y[:, None] - 1)).astype(np.float32)
    meta = (rng.normal(0, 1, (n, 6)) + 0.8 * (2 * y[:, None] - 1)).astype(np.float32)
    labelled = np.zeros(n, bool)
    labelled[:120] = True
    calibration = labelled & (np.arange(n) % 3 == 0)
    model = cotraining.cotrain((content, meta), y, labelled, calibration)
    c, m, both = cotraining._scores(model, content[200:], meta[200:])
    accuracy = [((x >= 0.5) == y[200:]).mean() for x in (c, m, both)]
    assert accuracy[2] >= max(accuracy[:2]) - 0.01 and accuracy[2] > 0.95


def test_pseudo_labels_come_from_all_documents(spark):
    rng = random.Random(8)
    words = [[f"{c}{rng.randrange(10**6)}" for _ in range(30)] for c in ("bad", "good")]
    rows = [
        (i, " ".join(rng.choices(words[i % 2], k=8)), "en", f"s{i % 2}", 50) for i in range(10_000)
    ]
    df = spark.createDataFrame(rows, data.DOCS)
    lab = data.labels(spark, [(i, i % 2, 0) for i in range(80)])
    sample = cotraining.training_sample(spark, df, lab)
    # Beyond any fixed pool: each document is there once, the labelled ones apart.
    assert sample.where("label is null").count() == len(rows) - 80
    model = cotraining.fit(sample)
    got = cotraining.score(df, model).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in got) / len(got) > 0.98
    # Cuts reach the share of the whole pool, or all that is sure.
    counts = [{"slot": -1, "bin": 0, "n": 1000}, *({"slot": 3, "bin": b, "n": 30} for b in range(9))]
    assert cotraining._cuts(counts, 0.1)[1, 1] == 5


def test_quality_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    lab = spark.read.parquet(f"{SF_SMOKE}/labels.parquet")
    train = lab.where("doc_id % 3 <> 1")
    model = cotraining.fit(cotraining.training_sample(spark, docs, train))
    rows = cotraining.score(docs, model).join(lab.where("doc_id % 3 = 1"), "doc_id").collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) >= 0.9


def test_quality_classifier_cases(spark):
    df, rows = data.messy(spark)
    none = cotraining.fit(cotraining.training_sample(spark, df, data.labels(spark, [(1, 1, 0)])))
    assert none is None
    got = cotraining.score(df, none).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {0.5}
    lab = data.labels(spark, [(i, i % 2, 0) for i in range(1, 11)] + [(3, 0, 0), (None, 1, 0)])
    model = cotraining.fit(cotraining.training_sample(spark, df, lab))
    got = cotraining.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    empty = data.empty(spark)
    assert cotraining.score(empty, cotraining.fit(cotraining.training_sample(spark, empty, lab))).count() == 0


def test_registered():
    names = list(queries.QUERIES)
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(queries.ORACLE_SQL) <= set(names)
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "pii", "mixing", "packing",
    ]


def test_pipeline_stages_on_messy_documents(spark, tmp_path):
    df, rows = data.messy(spark)
    lab = data.labels(spark, [(i, i % 2, 0) for i in range(1, 11)])
    lab.write.parquet(f"{tmp_path}/labels.parquet")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(spark, stage(spark, docs, str(tmp_path)), f"test-{name}")
        if name != "packing":
            assert out.columns == df.columns
        counts.append(out.count())
        docs = out
    # Blank and one-word texts and those that repeat themselves go; 1, 1, 2, 3 are one class.
    assert counts[0] == 6 and counts[1] == 3
    assert counts[3] >= 1 and counts[4] >= counts[3]
