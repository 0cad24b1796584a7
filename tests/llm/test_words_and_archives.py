"""Collocations, spelling variants and WARC archives against brute force."""

import glob
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sigfleet.llm import collocations, spelling, warc
from tests.llm import data

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- collocations ----------------------------------------------------------


def brute_collocations(rows, least, top=2000, longest=5):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        common = {p: n for p, n in c.items() if len(p) > 1 and n >= least}
        rows_ = []
        for p, a in common.items():
            inside = any(
                len(q) > len(p) and 100 * n >= 100 * a
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, n in common.items()
            )
            if not inside:
                cuts = [(1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows_.append((" ".join(p), a, c[p[:k]], c[p[k:]], total[lang], score))
        rows_.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows_[:top])]
    return sorted(out)


def phrases_text(rng, n):
    stock = ["new york city", "as well as", "one two three four five", "New York", "ÀB c", "x.y z"]
    return " ".join(
        rng.choice(stock) if rng.random() < 0.5 else f"w{rng.randrange(40)}" + rng.choice(["", ".", ",", "\n", "\t"])
        for _ in range(n)
    )


def text_rows(seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice(["en", "de", None, "und", "a b"]), phrases_text(rng, rng.randrange(200))) for _ in range(60)]
    return [*rows, ("en", None), (None, ""), ("en", " \t\n.."), ("fr", "z " * 3_000), rows[0], rows[0]]


@pytest.mark.parametrize("tiny", [False, True])
def test_collocations_equal_brute_force(spark, monkeypatch, tiny):
    if tiny:  # many runs, bursts and spills; a bitmap that lets everything through
        for name, value in [("CHUNK", 500), ("RUN", 300), ("BURST", 2), ("HELD", 20), ("MAP_BITS", 10)]:
            monkeypatch.setattr(collocations, name, value)
        monkeypatch.setattr(collocations.HatTrie.__init__, "__defaults__", (2, 3))
    rows = text_rows()
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as n", "2 as phrase", "3 as k")
    for top in (2000, 5):
        got = collocations.collocations(spark, df, min_count=12, top=top)
        assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 12, top)
        assert len(brute_collocations(rows, 12, top)) > 5


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark, data.empty(spark)).collect() == []
    messy, rows = data.messy(spark)
    assert sorted(map(tuple, collocations.collocations(spark, messy, min_count=3).collect())) == brute_collocations(
        [(r[2], r[1]) for r in rows], 3
    )


def test_scores_pass_64_bits(spark, monkeypatch):
    big = 4_000_000_000_000
    counts = [("en", 0, "", 9 * big), ("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)]
    table = spark.createDataFrame(counts, "lang string, k int, phrase string, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a: table)
    (row,) = collocations.collocations(spark, data.empty(spark)).collect()
    assert row.score == 1000 * (big - 1) * 9 * big // (big * (big + 1))


def test_runs_keep_values():
    rng = np.random.default_rng(1)
    v = np.unique(rng.integers(0, 2**40, 1000).astype(np.uint64))
    n = rng.integers(1, 2**40, len(v)).astype(np.uint64)
    a, b = collocations.decoded_run(collocations.encoded_run(v, n))
    assert (a == v).all() and (b == n).all()


def test_trie_counts_bursts_and_spills():
    rng = random.Random(2)
    trie, want, got = collocations.HatTrie(burst=3, levels=3), Counter(), Counter()
    for i in range(3_000):
        p = tuple(rng.randrange(6) for _ in range(rng.randrange(1, 6)))
        trie.add(p, 2)
        want[p] += 2
        if i % 700 == 699:
            before = len(trie)
            for q, n in trie.spill(before // 2):
                got[q] += n
            assert len(trie) <= before // 2
    for q, n in trie.spill(0):
        got[q] += n
    assert got == want and len(trie) == 0


# --- spelling variants -----------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    c = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                c[run] += 1
    c = {w: n for w, n in c.items() if n >= 3}
    form, near_n = {}, {}
    for w, n in c.items():
        near = [v for v in c if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        near_n[w] = len(near)
        best = min(near, key=lambda v: (-c[v], v), default=None)
        form[w] = best if best and c[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, near_n[w], c.get(form[w])) for w, n in c.items())


def word_rows(seed=1):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abéßaÿ") for _ in range(rng.randrange(4, 9))) for _ in range(30)]
    out = []
    for doc in range(80):
        words = []
        for _ in range(120):
            w = rng.choice(stems[: 1 + doc % 30])
            if rng.random() < 0.3:
                i = rng.randrange(len(w))
                w = w[:i] + rng.choice(["", "a", w[i] * 2]) + w[i + 1 :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        out.append((doc, rng.choice([" ", "-", "÷", "1"]).join(words)))
    long = "q" * 3_000
    out += [(900, f"{long} {long} {long} {long}r {long}r {long}r"), (901, None), (902, ""), (None, "niemals " * 5)]
    return [*out, out[3], out[3]]


@pytest.mark.parametrize("block", [512, 3])
def test_variants_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "SMALL", 4)
    monkeypatch.setattr(spelling, "HELD", 50)
    rows = word_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as s")
    got = spelling.variants(spark, spelling.word_counts(df))
    want = brute_variants(rows)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(w[1] is not None for w in want) > 20 and any(w[1] != w[2] and w[1] for w in want)


def test_variants_of_nothing(spark):
    got = spelling.variants(spark, spelling.word_counts(data.empty(spark)))
    assert got.collect() == []
    messy, rows = data.messy(spark)
    got = spelling.variants(spark, spelling.word_counts(messy))
    assert sorted(map(tuple, got.collect())) == brute_variants([r[:2] for r in rows])


def test_a_chain_of_forms_ends_at_its_root(spark):
    chain = [("w" + "a" * i, 3 * 2**i) for i in range(20)]
    got = spelling.variants(spark, spark.createDataFrame(chain, "word string, n long"))
    assert {r.root for r in got.collect()} == {"w" + "a" * 19}


# --- archives --------------------------------------------------------------


PAGE = "page_id long, url string, html string"


def page_rows():
    long = "<p>ünïcode</p>" * 20
    tricky = [
        "a\r\n\r\nb" * 30, "x" * 200 + "\r\n", "x" * 200 + "\r\n\r\n", "\r\n\r\n\r\n" * 40, "\r\n" + "y" * 120,
        "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3, "\r" * 150, "\n" * 150,
        "", None, "short", "short", "z" * 99, "z" * 99, "z" * 100, "z" * 100, "k" * 300_000,
    ]
    rows = [(i, f"http://e.invalid/{i}", t) for i, t in enumerate(tricky)]
    rows += [(100 + i, None if i % 3 else "http://e.invalid/a b\r\nX: y", long) for i in range(40)]
    rows += [(50, "u", long), (50, "u", long), (None, "n", long), (None, None, "n" * 120), (None, None, "n" * 120)]
    return rows


def brute_pages(rows):
    out, groups = [], defaultdict(list)
    for i, (page, _, html) in enumerate(rows):
        groups[(html or "").encode()].append((page is None, page or 0, i))
    for payload, members in groups.items():
        members.sort()
        first = rows[members[0][2]][0]
        for nth, (_, _, i) in enumerate(members):
            revisit = nth > 0 and len(payload) >= 100
            out.append((
                rows[i][0], len(payload), hashlib.sha256(payload).hexdigest(),
                "revisit" if revisit else "response", first if revisit else None,
            ))
    return Counter(out)


def test_archives_round_trip(spark):
    rows = page_rows()
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "1 as row", "2 as payload_digest", "'x' as value")
    raw = warc.write_archives(spark, df.repartition(3))
    back = warc.read_archives(spark, raw, with_payload=True).collect()
    assert Counter((r.page_id, bytes(r.payload)) for r in back) == Counter(
        (p, (h or "").encode()) for p, _, h in rows
    )
    assert len({r.record_id for r in back}) == len(rows)
    urls = {r.url for r in back}
    assert "http://e.invalid/a%20b%0D%0AX:%20y" in urls and None in urls
    slim = warc.deduplicated(spark, raw)
    got = warc.payloads(spark, slim).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, got.collect())) == brute_pages(rows)
    kinds = Counter(r.type for r in warc.read_archives(spark, slim).collect())
    assert kinds["revisit"] == sum(n for r, n in brute_pages(rows).items() if r[3] == "revisit")


def test_archives_are_valid_records(spark):
    rows = page_rows()
    path = warc.deduplicated(spark, warc.write_archives(spark, spark.createDataFrame(rows, PAGE).coalesce(1)))
    seen = 0
    for f in glob.glob(path.removeprefix("file:") + "/*.gz"):
        raw = gzip.open(f).read()
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
            revisit = fields[b"WARC-Type"] == b"revisit"
            assert revisit == (b"WARC-Refers-To" in fields)
            payload = rest[:n].partition(b"\r\n\r\n")[2]
            if revisit:
                assert payload == b""
            else:
                assert fields[b"WARC-Payload-Digest"] == b"sha256:" + hashlib.sha256(payload).hexdigest().encode()
            raw = rest[n + 4 :]
            seen += 1
    assert seen == len(rows)


def test_archives_of_nothing(spark):
    empty = spark.createDataFrame([], PAGE)
    assert warc.payloads(spark, warc.deduplicated(spark, warc.write_archives(spark, empty))).collect() == []


def test_a_cut_archive_is_an_error():
    whole = b"WARC/1.1\r\nContent-Length: 10"
    assert list(warc.records(iter([whole, b"0123456789"])))[0][1] == b"0123456789"
    with pytest.raises(ValueError):
        list(warc.records(iter([whole, b"01"])))
