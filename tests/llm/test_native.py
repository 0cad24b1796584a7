"""PII, mixing, license scan and quality rules against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sigfleet.llm import license_scan, mixing, pii, quality_rules
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")

KINDS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def expected_spans(text):
    out = []
    for k, (name, pattern) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if name == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if name == "card" and not (12 <= len(d) <= 19 and luhn(d)):
                continue
            if name == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


ODD_TEXTS = [
    "a@b.c@d.e x@y.z.w%q@r.s",
    "mail é😀 to joe.o+x@mail-1.example.com, or a@b a@b. @c.d",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 0001.02.3.255 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111",
    "call +1 (555) 123-4567 or +49 30 901820 ext +1 2 +123456789012345678",
    "+1.2.3.4567890 4111111111111111@x.y",
    "",
    None,
    "😀+44 20 7946 0958\n10.0.0.1",
]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(3)
    alphabet = "a1.@+- ()%é9"
    texts = ODD_TEXTS + ["".join(rng.choice(alphabet) for _ in range(80)) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = pii.sanitise(spark, df)
    rows = got.select(
        "doc_id",
        *[pii.kind_count(F.col("spans"), k).alias(k) for k in pii.KINDS],
        pii.span_text(F.col("spans")).alias("s"),
    ).collect()
    assert len(rows) == len(texts)
    for r in rows:
        e = expected_spans(texts[r.doc_id])
        assert r.s == ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in e), texts[r.doc_id]
        assert [r[k] for k, _ in KINDS] == [sum(x[1] == i for x in e) for i in range(4)]


def test_disclosing_terms_are_found_and_common_ones_are_not(spark):
    rows = []
    for i in range(6):  # different contexts around one address
        rows.append((i, f"number {i} zylophane writes from boss@corp.example the day {i * 7}"))
    rows += [(100 + i, f"the day number {i} writes from nowhere at all") for i in range(60)]
    # Copies of one text: its words occur nowhere else but prove nothing.
    rows += [(300 + i, "quintarel speaks to lone@site.example alone") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.sanitise(spark, df).collect()}
    for i in range(6):
        terms = [s for s in out[i].all_spans if s.kind >= pii.GENERAL]
        assert [rows[i][1][s.start : s.end] for s in terms] == ["zylophane"]
        assert len(out[i].spans) == 1 and out[i].spans[0] in out[i].all_spans
    assert all(len(out[i].all_spans) == 1 for i in range(300, 308))
    assert all(not out[100 + i].all_spans for i in range(60))
    new = {r.doc_id: r.text for r in pii.sanitise_documents(spark, df, length_col=None).collect()}
    assert "zylophane" not in new[0] and "boss@" not in new[0] and "<EMAIL>" in new[0]
    assert new[100] == rows[6][1]


def test_disclosing_terms_at_any_distance(spark):
    rng = random.Random(11)
    rows = []
    for i in range(8):
        far = data.sentence(rng, 60)
        # The name stands near the address in two texts only; it goes everywhere.
        near = "Zylophane" if i < 2 else "someone"
        text = f"{near} at boss@corp.example {far} Zylophane, {far} zylophane"
        rows.append((i, text))
    rows += [(100 + i, f"{data.sentence(rng, 40)} someone at nowhere") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.sanitise(spark, df).collect()}
    for i, text in rows:
        want = [m.span() for m in re.finditer("(?i)zylophane", text)]
        got = [(s.start, s.end) for s in out[i].all_spans if s.value == "zylophane"]
        assert got == want, i
    new = {r.doc_id: r.text for r in pii.sanitise_documents(spark, df, length_col=None).collect()}
    assert all("zylophane" not in t.lower() for t in new.values())


def test_rare_values_get_the_terms_of_broader_entities(spark):
    rng = random.Random(12)
    rows = []
    for i in range(6):  # every address once, one domain
        rows.append((i, f"{data.sentence(rng, 20)} zylophane u{i}@corp.example"))
    for i in range(6):  # every number once, one prefix
        rows.append((20 + i, f"{data.sentence(rng, 20)} quintarel +44 20 7946 00{i}1"))
    for i in range(6):  # nothing in common but the kind
        rows.append((40 + i, f"{data.sentence(rng, 20)} mandrovik {10 + i}.{20 + i}.0.1"))
    rows += [(60 + i, f"{data.sentence(rng, 20)} someone at nowhere") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.sanitise(spark, df).collect()}
    for first, name in ((0, "zylophane"), (20, "quintarel"), (40, "mandrovik")):
        for i in range(first, first + 6):
            assert name in {s.value for s in out[i].all_spans if s.kind == pii.REMOVE}, (i, name)
    assert not any(out[60 + i].all_spans for i in range(300))


def plain_entities(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == 0:
        group, own = "@" + value.lower().rsplit("@", 1)[1], value.lower()
    elif kind == 1:
        group, own = ".".join(value.split(".")[:2]) + ".*", value
    else:
        group, own = digits[: 6 if kind == 2 else 4] + "*", digits
    return {f"{kind}", f"{kind}:{group}", f"{kind}:{own}"}


def plain_disclosure(rows, contexts=3, generalise=0.8, remove=0.95, chance=0.01):
    """``text: {(start, end, kind)}`` of all spans, and the pairs tried."""
    copies = Counter(t or "" for _, t in rows)
    total, clear, entities = len(rows), {}, {}
    for t in copies:
        spans = expected_spans(t)
        words = [m.span() for m in re.finditer(r"[^\W_]+", t)]
        clear[t] = [
            (a, b) for a, b in words if b - a >= 2 and not any(a < e and s < b for s, _, e in spans)
        ]
        entities[t] = set().union(*[plain_entities(k, t[s:e]) for s, k, e in spans])
    terms = {t: {t[a:b].lower() for a, b in c} for t, c in clear.items()}
    with_entity, with_term = {}, {}
    for t in copies:
        for e in entities[t]:
            with_entity.setdefault(e, set()).add(t)
        for w in terms[t]:
            with_term.setdefault(w, set()).add(t)

    def docs(texts):
        return sum(copies[t] for t in texts)

    held = {t for t in copies if entities[t]}
    able_e = {e: ts for e, ts in with_entity.items() if len(ts) >= contexts}
    most = {e: total * (docs(ts) / total) ** generalise + 1 for e, ts in able_e.items()}
    able_t = {
        w: ts
        for w, ts in with_term.items()
        if len(ts & held) >= contexts and docs(ts) <= max(most.values(), default=0)
    }
    tried = max(len({frozenset(ts) for ts in able_e.values()}), 1) * max(
        len({(frozenset(ts & held), docs(ts)) for ts in able_t.values()}), 1
    )
    out = {t: {(s, e, k) for s, k, e in expected_spans(t)} for t in copies}
    for e, te in able_e.items():
        for w, tw in able_t.items():
            both = te & tw
            p, n_both, n_term = docs(te) / total, docs(both), docs(tw)
            if len(both) < contexts or p == 1:
                continue
            share = math.log2(n_both / (p * n_term)) / -math.log2(p)
            k, n = len(both), len(both) + n_term - n_both
            bound = 0.0
            if k > n * p:
                bound = -k * math.log(k / (n * p))
                bound -= (n - k) * math.log((n - k) / (n * (1 - p))) if n > k else 0
            if share < generalise or bound > math.log(chance / tried):
                continue
            kind = pii.REMOVE if share >= remove else pii.GENERAL
            for t in both:
                for a, b in clear[t]:
                    if t[a:b].lower() == w:
                        out[t] = {x for x in out[t] if x[:2] != (a, b) or x[2] >= kind} | (
                            set() if (a, b, pii.REMOVE) in out[t] else {(a, b, kind)}
                        )
    return out


def test_disclosure_equals_plain(spark):
    rng = random.Random(21)
    names = ["zylophane", "quintarel", "mandrovik", "ostrellin"]
    rows = []
    for i in range(160):
        text = data.sentence(rng, 25, 60)
        if i % 2:
            k = rng.randrange(4)
            text = (
                f"{names[k]}\nu{rng.randrange(2)}@corp{k}.example, {text} {names[rng.randrange(4)]}"
                f" of +44 20 7946 0{k}{rng.randrange(3)}1; {names[k]}_{rng.choice(names)} {names[k]}"
            )
        rows += [(len(rows), text)] * (1 + (i % 5 == 0))
    # Two of the names also stand in a few texts without personal data.
    rows += [
        (1000 + i, f"plain {data.sentence(rng, 20, 60)} {names[i % 2] if i < 24 else ''}")
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_disclosure(rows)
    got = pii.sanitise(spark, df).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert {(s.start, s.end, s.kind) for s in r.all_spans} == want[texts[r.doc_id]], r.doc_id
        assert len(r.all_spans) == len(want[texts[r.doc_id]])
    kinds = Counter(k for spans in want.values() for _, _, k in spans)
    assert kinds[pii.GENERAL] and kinds[pii.REMOVE]


def test_rare_words_beside_many_entities_are_chance(spark):
    rng = random.Random(22)
    rows = [
        (i, data.sentence(rng, 20, 4_000) + (f" u{i}@site{i}.example" if i % 3 == 0 else ""))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = Counter(s.kind for r in pii.sanitise(spark, df).collect() for s in r.all_spans)
    assert spans == {0: 300}


def test_text_of_many_addresses(spark):
    many = " ".join(f"u{i}@host{i}.example w{i}x" for i in range(10_000))
    rows = [(i, f"{many} zylophane {i}") for i in range(3)]
    rows += [(10 + i, f"word {i} w{i}x") for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.sanitise(spark, df).collect()}
    for i in range(3):
        assert len(out[i].spans) == 10_000
        assert [(s.start, s.end) for s in out[i].spans] == [
            m.span() for m in re.finditer(r"u\d+@host\d+\.example", rows[i][1])
        ]
    new = {r.doc_id: r.text for r in pii.sanitise_documents(spark, df, length_col=None).collect()}
    assert new[0].count("<EMAIL>") == 10_000 and "@" not in new[0]


def test_pii_messy_and_empty(spark):
    df, rows = data.messy(spark)
    got = pii.sanitise(spark, df).select("doc_id", pii.span_text(F.col("spans")).alias("s"))
    want = Counter(
        (r[0], ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in expected_spans(r[1]))) for r in rows
    )
    assert Counter((r.doc_id, r.s) for r in got.collect()) == want
    out = pii.sanitise_documents(spark, df)
    assert out.columns == df.columns and out.count() == len(rows)
    assert out.where("text is null").count() == sum(r[1] is None for r in rows)
    assert pii.sanitise(spark, data.empty(spark)).count() == 0


def plain_mix(rows, weights=(5, 2, 1), repeats=3):
    """Words taken per row, by the definition, in plain Python."""
    queues = {}
    for n, (doc_id, text, source) in enumerate(rows):
        key = hashlib.md5(
            (("" if doc_id is None else str(doc_id)) + ":" + (text or "")).encode()
        ).hexdigest()
        queues.setdefault(source, []).append((key, len(WORD.findall(text or "")), n))
    names = sorted(queues, key=lambda s: (s is None, s or ""))
    items = []
    for r, s in enumerate(names):
        w, at = weights[r % len(weights)], 0
        q = sorted(queues[s])
        for turn in range(repeats):
            for key, size, n in q:
                at += size
                items.append((at / w, r, key, size, n, turn))
    budget = sum(size for q in queues.values() for _, size, _ in q)
    taken = Counter()
    for _, _, _, size, n, _ in sorted(items):
        take = min(size, budget)
        taken[n] += take
        budget -= take
    return taken


def test_mixing_equals_plain(spark):
    df, rows = data.messy(spark)
    rng = random.Random(9)
    more = [(i, data.sentence(rng, rng.randrange(1, 50)), "en", f"s{i % 5}", 1) for i in range(20, 220)]
    both = df.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(more, data.DOCS)
    )
    plain = [(r[0], r[1], r[3]) for r in rows + more]
    taken = plain_mix(plain)
    want = Counter(
        (r[0], r[2], len(WORD.findall(r[1] or "")), taken[n]) for n, r in enumerate(plain)
    )
    got = mixing.mix(spark, both)
    assert Counter((r.doc_id, r.source, r.size, r.taken) for r in got.collect()) == want
    per = got.groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("m"),
        F.first("source_size").alias("s"),
    ).collect()
    assert abs(sum(r.g for r in per) - sum(r.s for r in per)) < 1e-6
    assert all(abs(r.t - r.g) <= r.m and r.g <= 3 * r.s + 1e-9 for r in per)


def test_mix_documents_keeps_columns_and_repeats(spark):
    df, _ = data.messy(spark)
    out = mixing.mix_documents(spark, df)
    assert out.columns == df.columns
    assert out.where("text is null or trim(text) = ''").count() == 0
    assert mixing.mix(spark, data.empty(spark)).count() == 0
    assert mixing.mix_documents(spark, data.empty(spark)).count() == 0


def test_hot_source_is_split(spark):
    """A source with most rows is queued in buckets, not in one window."""
    assert mixing._bucket_digits(16_384) == 0
    assert mixing._bucket_digits(16_385) == 1
    assert mixing._bucket_digits(16_384 * 256 + 1) == 3


PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_license(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = LICENSE_WORD.findall((text or "").translate(low))
    places, labels = [], set()
    for p, label in PHRASES.items():
        q = p.split()
        for i in range(len(w) - len(q) + 1):
            if w[i : i + len(q)] == q:
                places.append(i)
                labels.add(label)
    return (
        len(w), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(labels)),
    )


def test_license_scan_base_and_method(spark):
    mit = license_scan.NOTICES[0].text.split()
    edited = mit[:20] + ["very"] + mit[20:40] + mit[41:]
    texts = [
        "Released under the MIT License. under the mit license",
        "CC BY-NC; cc by nc cc by nc. Apache License, Version 2.0!",
        "under the MİT license under the mit licenſe underé the mit license",
        "under the mit",
        None,
        "",
        "noise " * 40 + " ".join(edited) + " tail",
        "permission is hereby granted to nobody at all",
        "the Kelvin K license under the mit license",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs, spans = license_scan.scan(spark, df)
    got = {r.doc_id: r for r in docs.collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_license(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert got[6].labels == "mit" and got[6].n_base == 0 and got[6].score > 0.7
    assert got[7].labels == "" and 0 < got[7].score < 0.7
    span = spans.where("accepted and not phrase and label = 'mit'").orderBy("first_word").collect()
    assert any(r.first_word == 40 and r.end_word == 40 + len(edited) for r in span)


def test_license_scan_longer_insertion(spark):
    text = (
        "noise " * 30 + "Redistribution and use in source and binary forms, with or without "
        "modification, are permitted (subject to the limitations in the disclaimer below) "
        "provided that the following conditions are met: " + "tail " * 30
    )
    twice = " ".join([license_scan.NOTICES[4].text] * 2)
    df = spark.createDataFrame([(1, text), (2, twice)], "doc_id long, text string")
    docs, spans = license_scan.scan(spark, df)
    assert {r.labels for r in docs.collect()} == {"bsd"}
    got = spans.where("accepted and label = 'bsd'").select("first_word", "end_word").collect()
    n = len(license_scan.NOTICES[4].text.split())
    assert sorted(map(tuple, got)) == [(0, n), (n, 2 * n), (30, 30 + n + 8)]


def test_license_scan_messy_and_empty(spark):
    df, rows = data.messy(spark)
    docs, _ = license_scan.scan(spark, df)
    got = Counter((r.doc_id, r.n_words, r.n_base) for r in docs.collect())
    assert got == Counter((r[0], *plain_license(r[1])[:2]) for r in rows)
    assert license_scan.scan(spark, data.empty(spark))[0].count() == 0
    with pytest.raises(ValueError):
        license_scan.template_positions(spark, [license_scan.Template("x", "two words")])


def plain_statistics(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def stat_rows(df):
    q = F.col("qstat")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return df.select("doc_id", *[q[n].alias(n) for n in names])


def test_statistics_equal_plain(spark):
    rng = random.Random(11)
    df, rows = data.messy(spark)
    texts = [
        "a a a a a a a a a",
        "a b c d e f a b c d e",
        "x\nx\n\n \nx y\nx y\r\nx\n",
        "# $ é|< ok\x0bb\x0cc",
        *[" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(100)],
    ]
    more = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(texts)]
    both = df.select("doc_id", "text").unionByName(
        spark.createDataFrame(more, data.DOCS).select("doc_id", "text")
    )
    got = stat_rows(quality_rules.document_statistics(both)).collect()
    want = Counter((r[0], *plain_statistics(r[1])) for r in rows + more)
    assert Counter(tuple(r) for r in got) == want


def quality_corpus(n=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        words = [data.sentence(rng, 1) for _ in range(rng.randrange(20, 60))]
        bad = i % 4 == 0
        if bad:
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        docs.append((i, " ".join(words), "en", "s", 1))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def test_decision_list_learns_and_applies(spark):
    docs, labels = quality_corpus()
    df = spark.createDataFrame(docs, data.DOCS)
    rules = quality_rules.fit(spark, df, data.labels(spark, labels))
    assert rules and all(r.precision >= 0.99 and str(r).startswith("reject if") for r in rules)
    out = quality_rules.score(df, rules).select("doc_id", F.col("qrule")["kept"].alias("k")).collect()
    assert {r.doc_id for r in out if not r.k} == {d[0] for d in docs if d[0] % 4 == 0}


def test_filter_documents_messy_and_without_labels(spark):
    df, rows = data.messy(spark)
    out = quality_rules.filter_documents(spark, df, data.labels(spark))
    assert out.columns == df.columns
    want = Counter()
    for r in rows:
        n, _, _, _, rep = plain_statistics(r[1])
        if n >= 10 and 100 * rep <= 20 * n:
            want[r[0]] += 1
    assert Counter(r.doc_id for r in out.collect()) == want
    assert out.where("qstat = 5").count() == sum(want.values())  # the input's own column
    none = data.empty(spark)
    assert quality_rules.filter_documents(spark, none, data.labels(spark, [(1, 1, 0)])).count() == 0


def test_conflicting_and_null_labels_are_not_learned_from(spark):
    df = spark.createDataFrame([(1, "a b", "en", "s", 1), (2, "c d", "en", "s", 1)], data.DOCS)
    lab = data.labels(spark, [(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (2, 1, 1)])
    assert [r.good for r in quality_rules.labelled_sample(df, lab).collect()] == [True]


def plain_rules(rows, cuts, max_rules=8, max_conditions=3, min_covered=10, min_precision=0.99):
    """Sequential covering over plain rows ``(good, prune, {feature: value})``."""
    from math import log2

    def holds(c, r):
        name, above, cut = c
        return (r[2][name] > cut) if above else (r[2][name] <= cut)

    def best(rows):
        p0, n0 = sum(not r[0] for r in rows), sum(r[0] for r in rows)
        found, gain, width = None, 1e-9, 0.0
        if not p0 or not n0:
            return None
        for name in quality_rules.FEATURES:
            values = sorted(r[2][name] for r in rows)
            for cut in cuts[name]:
                low = [v for v in values if v <= cut]
                high = [v for v in values if v > cut]
                if not low or not high or (low and any(c < cut and c >= low[-1] for c in cuts[name])):
                    continue
                middle, gap = (low[-1] + high[0]) / 2, (high[0] - low[-1]) / (values[-1] - values[0])
                for above in (False, True):
                    inside = [r for r in rows if holds((name, above, middle), r)]
                    p, n = sum(not r[0] for r in inside), sum(r[0] for r in inside)
                    if p < min_covered:
                        continue
                    g = p * (log2((p + 1) / (p + n + 2)) - log2((p0 + 1) / (p0 + n0 + 2)))
                    if g > gain + 1e-9 or (g > gain - 1e-9 and gap > width):
                        found, gain, width = (name, above, middle), max(g, gain), gap
        return found

    rules, left = [], list(rows)
    while len(rules) < max_rules:
        conditions, inside = [], [r for r in left if not r[1]]
        while len(conditions) < max_conditions:
            c = best(inside)
            if c is None:
                break
            conditions.append(c)
            inside = [r for r in inside if holds(c, r)]
        if not conditions:
            break

        def covered(k, rows, conditions=conditions):
            return [r for r in rows if all(holds(c, r) for c in conditions[:k])]

        def value(k):
            x = covered(k, [r for r in left if r[1]])
            return sum(1 if not r[0] else -1 for r in x) / max(1, len(x))

        k = min(range(1, len(conditions) + 1), key=lambda k: (-value(k), k))
        x = covered(k, left)
        bad = sum(not r[0] for r in x)
        if bad < min_covered or bad / len(x) < min_precision:
            break
        rules.append(tuple(conditions[:k]))
        left = [r for r in left if r not in x]
    return rules


def test_learned_rules_equal_a_plain_covering(spark):
    rng = random.Random(17)
    rows = []
    for i in range(400):
        v = {f: round(rng.uniform(0, 1), 3) for f in quality_rules.FEATURES}
        a, b = quality_rules.FEATURES[0], quality_rules.FEATURES[2]
        rows.append((not (v[a] > 0.7 or (v[b] < 0.3 and v[a] > 0.4)), i % 3 == 0, v))
    kinds = ", ".join(f"{f}: double" for f in quality_rules.FEATURES)
    sample = spark.createDataFrame(rows, f"good boolean, prune boolean, qstat struct<{kinds}>")
    cuts = quality_rules._thresholds(sample, 24)
    got = quality_rules.learn_rules(sample, min_precision=0.8)
    want = plain_rules(rows, cuts, min_precision=0.8)
    assert [[(c.feature, c.above, round(c.threshold, 9)) for c in r.conditions] for r in got] == [
        [(f, a, round(t, 9)) for f, a, t in r] for r in want
    ]
    assert len(want) > 1
