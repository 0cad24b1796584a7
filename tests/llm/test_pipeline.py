"""The rows of the corpus pipeline against its stages in plain Python."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from sigfleet.llm import pii
from tests.llm import data
from tests.llm import test_native as native
from tests.llm import test_search_and_dedup as near

TOKENS = ["<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "<TERM>", ""]


def corpus(rng):
    texts = [data.sentence(rng, rng.randrange(12, 70), 5_000) for _ in range(60)]
    texts += near.near_copies(rng, data.sentence(rng, 80, 5_000), 6, 1)
    texts += [texts[0], texts[0], texts[1].upper()]
    for i in range(24):  # a name that goes with one domain, and other data
        texts.append(
            f"zylophane u{i}@corp.example {data.sentence(rng, 15, 5_000)} at 10.0.{i}.7"
            f" or +44 20 7946 0{i:02}1 zylophane"
        )
    texts += ["too short", "", None, "again and again " * 30]
    texts += [data.sentence(rng, 9_000, 5_000)]
    texts += [f"w1x {data.sentence(rng, 30, 5_000)} 😀 4111 1111 1111 1111 end" for _ in range(4)]
    sources = ["s1", "s1", "s1", "s2", "s3", None]
    return [
        (i, t, "en", sources[i % len(sources)], None if t is None else len(t))
        for i, t in enumerate(texts)
    ]


def good(text):
    n, _, _, _, repeated = native.plain_statistics(text)
    return n >= 10 and 100 * repeated <= 20 * n


def rewritten(text, spans):
    out, at = [], 0
    for start, kind, end in sorted((s, k, e) for s, e, k in spans):
        if start >= at:
            out += [text[at:start], TOKENS[kind]]
        at = max(at, end)
    return "".join(out) + text[at:]


def plain_pipeline(rows):
    """``doc_id, source, n_words`` of every document of the mix, per copy."""
    rows = [r for r in rows if good(r[1])]
    classes = near.brute_classes([(r[0], r[1]) for r in rows])
    kept = {doc for doc, least, _ in classes if doc == least}
    rows = [r for r in rows if r[0] in kept]
    spans = native.plain_disclosure([(r[0], r[1]) for r in rows])
    assert {k for s in spans.values() for _, _, k in s} >= {0, 1, 2, 3, pii.REMOVE}
    clean = [(r[0], rewritten(r[1], spans[r[1]]), r[3]) for r in rows]
    taken = native.plain_mix(clean)
    out = []
    for n, (doc, text, source) in enumerate(clean):
        size = len(native.WORD.findall(text))
        out += [(doc, source, size)] * int(taken[n] / size + 0.5)
    return clean, out


def test_rows_equal_plain_stages(spark, tmp_path):
    rows = corpus(random.Random(31))
    spark.createDataFrame(rows, data.DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    data.labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    clean, want = plain_pipeline(rows)

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.stored(spark, stage(spark, docs, str(tmp_path)), f"plain-{name}")
    got = {r.doc_id: (r.text, r.source, r.n_chars) for r in docs.collect()}
    assert got == {d: (t, s, len(t)) for d, t, s in clean}

    pieces = Counter()
    for doc, source, size in want:
        for p in range(-(-size // 4_096)):
            first = p * 4_096
            pieces[doc, source, p, first, min(4_096, size - first)] += 1
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.source, r.piece, r.first_word, r.n_words) for r in out) == pieces
    bins = defaultdict(list)
    for r in out:
        bins[r.bin].append(r)
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 4_096
        assert max(Counter(r.source for r in held).values()) <= 4
        assert max(Counter(r.doc_id for r in held).values()) == 1
