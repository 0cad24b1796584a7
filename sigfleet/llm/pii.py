"""Personal data: fixed patterns, and terms that disclose what they find.

The patterns find e-mail addresses, IP addresses, card and phone numbers.
Each value found belongs to protected entities of three levels: its kind, its
mail domain or number prefix, and the value itself, so that a value that is
too rare to count gets the terms of the broader ones. From all documents the
co-occurrence of entities with the terms of the texts that hold them gives, for a term ``t``
and an entity ``c``,

    disclosure = PMI(c; t) / IC(c),  PMI = log2(p(c, t) / (p(c) p(t))),
                                     IC  = -log2 p(c),

the share of the entity's information that the term gives away (1: the term
occurs nowhere else). Terms above ``generalise_at`` are replaced by a class
in the documents that hold the entity, above ``remove_at`` they are removed,
wherever they stand in the text. All probabilities are shares of documents;
a term counts where it stands outside of personal data, at any distance.
A pair counts only if it occurs in ``min_contexts`` different texts: one
text, however often copied, is one context and proves nothing. It must also be
beyond chance: Chernoff's bound of the chance that ``k`` of the ``n`` texts of
a term hold the entity, when each does with ``p(c)``, times the number of pairs
tried stays at or below ``max_chance``, so the pairs expected to be marked in
the whole corpus by chance alone are fewer than that. Terms are runs of two or
more letters or digits; a name of one letter is never one.

Built-in functions only. One pass over the texts finds spans and stores them
with the texts that have any; a second one counts in how many documents each
term occurs. Entities and terms that cannot reach a threshold (too few texts,
or a term too frequent for any entity) are left out before they are paired,
which changes no result. The co-occurrence step works on different texts and
their numbers of copies, so copies share its results. Entities that stand in
the same texts have the same counts, and so have terms of equal frequency: each
such set, told by a 128-bit hash of its texts, is paired once for all of its
members, so a text of thousands of addresses is no product of addresses and
terms. Offsets come from running sums in blocks, texts are cut by pages: the
work on a text does not grow with the square of its spans.

Defined cases: a null text is empty and has no span; repeated rows get equal
results; matches that fail their check are dropped without a retry; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.llm.common import packed_row, stored, text_key, whole

# Kinds in their order. The patterns match exactly what the
# plain forms
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   [0-9]([\x20-]?[0-9])+
#   \+[0-9][\x20().0-9-]+[0-9]
# match; possessive quantifiers and the look-behind (a match starts where a
# run starts, or where the last match ended) keep them linear on long runs.
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this has no match of the kind; cheap to test.
GATES = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.contains("+"),
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TERM = r"[^\p{L}\p{N}]+"
LETTER = r"[\p{L}\p{N}]"
MIN_TERM = 2
PAGE = 4096  # code points


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of numbers, ``op`` over 0 and all before it.

    Two levels of blocks of about the square root of its size.
    """

    def running(xs: Column) -> Column:
        first = F.array(F.lit(0))
        return F.aggregate(
            xs, first, lambda acc, x: F.array_append(acc, op(F.element_at(acc, -1), x))
        )

    def joined(blocks: Column, starts: Column) -> Column:
        return F.flatten(
            F.transform(
                blocks,
                lambda b, i: F.transform(
                    F.slice(b, 1, F.size(b) - 1), lambda x: op(F.get(starts, i), x)
                ),
            )
        )

    def scan(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.size(v) - 1, width),
            lambda i: running(F.slice(v, i + 1, width)),
        )
        return _let(
            blocks,
            lambda b: _let(
                running(F.transform(b, lambda x: F.element_at(x, -1))), lambda s: joined(b, s)
            ),
        )

    none = F.array().cast("array<int>")
    return _let(values, lambda v: F.when(F.size(v) > 0, scan(v)).otherwise(none))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _pages(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))


def _cut(pages: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text in pages."""
    first = F.floor(start / PAGE).cast("int")
    n = F.floor(end / PAGE).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(pages, first + 1, n), ""), start % PAGE + 1, end - start)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    places = F.split(F.reverse(_digits(value)), "")
    total = F.aggregate(
        F.transform(
            places,
            lambda d, i: F.when(i % 2 == 0, F.try_to_number(d, F.lit("9")).cast("int")).otherwise(
                F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                      F.try_to_number(d, F.lit("9")).cast("int"))
            ),
        ),
        F.lit(0),
        lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _places(found: Column, kind: int) -> Column:
    """Spans from the matches ``m`` and the stretches ``g`` between them."""

    def spans(f: Column, before: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            a = F.get(before, i) + F.length(F.get(f["g"], i))
            return F.struct(
                a.alias("start"),
                F.lit(kind).alias("kind"),
                (a + F.length(m)).alias("end"),
                m.alias("value"),
            )

        return F.transform(f["m"], one)

    def sizes(f: Column) -> Column:
        return F.transform(f["m"], lambda m, i: F.length(m) + F.length(F.get(f["g"], i)))

    return _let(found, lambda f: _let(_before(sizes(f), _plus), lambda b: spans(f, b)))


def base_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the pattern spans by start, then kind.

    Offsets are code points, the end exclusive. Uses names starting with
    ``out`` for its steps and drops them.
    """
    t = F.col(text)
    keep = [F.col(f"`{c}`") for c in df.columns if not c.startswith(out)]
    empty = F.array().cast("array<string>")
    raw = df.select(
        *keep,
        *[
            F.when(
                GATES[k](t),
                F.struct(
                    F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0)).alias("m"),
                    F.split(t, PATTERNS[k], -1).alias("g"),
                ),
            ).alias(f"{out}_{k}")
            for k in KINDS
        ],
    )
    spans = [
        F.when(
            F.size(F.coalesce(F.col(f"{out}_{k}")["m"], empty)) > 0,
            _checked(_places(F.col(f"{out}_{k}"), i), k),
        ).otherwise(F.array().cast(SPAN))
        for i, k in enumerate(KINDS)
    ]
    return raw.select(*keep, F.array_sort(F.concat(*spans)).alias(out))


def _checked(spans: Column, kind: str) -> Column:
    if kind == "email":
        return spans
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def kind_count(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS + TERM_KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


TERM_KINDS = ["general", "remove"]
GENERAL, REMOVE = len(KINDS), len(KINDS) + 1


def _entity(span: Column) -> Column:
    """Protected value: lower-cased, for numbers the digits only."""
    return F.concat_ws(
        ":",
        span["kind"].cast("string"),
        F.when(span["kind"] >= KINDS.index("card"), _digits(span["value"])).otherwise(
            F.lower(span["value"])
        ),
    )


def _entities(span: Column) -> Column:
    """Protected entities of a span, from broad to narrow.

    Its kind; the mail domain, the first two numbers of an IP address, the
    first six digits of a card or four of a phone number; the value itself.
    """
    kind, digits = span["kind"], _digits(span["value"])
    group = (
        F.when(
            kind == KINDS.index("email"),
            F.concat(F.lit("@"), F.substring_index(F.lower(span["value"]), "@", -1)),
        )
        .when(
            kind == KINDS.index("ip"),
            F.concat(F.substring_index(span["value"], ".", 2), F.lit(".*")),
        )
        .when(kind == KINDS.index("card"), F.concat(F.substring(digits, 1, 6), F.lit("*")))
        .otherwise(F.concat(F.substring(digits, 1, 4), F.lit("*")))
    )
    k = kind.cast("string")
    return F.array(k, F.concat_ws(":", k, group), _entity(span))


def find(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored ``row, doc_id, key, spans, text`` of every document.

    ``text`` is there only where spans are.
    """
    df = docs.select(
        F.col(id_col).alias("doc_id"),
        whole(F.col(text_col)).alias("text"),
    )
    return stored(
        spark,
        base_spans(df, "text", "spans").select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            text_key(F.col("text")).alias("key"),
            "spans",
            F.when(F.size("spans") > 0, F.col("text")).alias("text"),
        ),
        "pii-found",
    )


def _clear_parts(text: Column, spans: Column) -> Column:
    """``at, part``: what stands outside the spans and the words reaching into them."""
    touches_left = rf"^{LETTER}++"
    touches_right = rf"(?<!{LETTER}){LETTER}++\z"

    def trimmed(raw: Column, start: Column) -> Column:
        # The right end is cut already; what goes on the left moves the start.
        return _let(
            F.when(start > 0, F.regexp_replace(raw, touches_left, "")).otherwise(raw),
            lambda x: F.struct((start + F.length(raw) - F.length(x)).alias("at"), x.alias("part")),
        )

    def part(pages: Column, start: Column, end: Column, last: bool) -> Column:
        raw = _cut(pages, start, end)
        if not last:
            raw = F.regexp_replace(raw, touches_right, "")
        return _let(raw, lambda r: trimmed(r, start))

    def parts(pages: Column, s: Column, before: Column) -> Column:
        inner = F.transform(
            s,
            lambda x, i: F.when(
                x["start"] > F.get(before, i), part(pages, F.get(before, i), x["start"], False)
            ),
        )
        end = F.greatest(F.lit(0), F.array_max(F.transform(s, lambda x: x["end"])))
        return F.concat(
            F.filter(inner, lambda x: x.isNotNull()),
            F.array(part(pages, end, F.length(text), True)),
        )

    def reached(s: Column) -> Column:
        return _before(F.transform(s, lambda x: x["end"]), F.greatest)

    return _let(
        spans,
        lambda s: _let(_pages(text), lambda p: _let(reached(s), lambda b: parts(p, s, b))),
    )


def _outside(text: Column, spans: Column) -> Column:
    """``text`` without its spans and the words that reach into them."""
    return F.array_join(F.transform(_clear_parts(text, spans), lambda p: p["part"]), " ")


def _term_hashes(text: Column) -> Column:
    """Hashes of the different terms of a text."""
    words = F.filter(F.split(F.lower(text), TERM), lambda w: F.length(w) >= MIN_TERM)
    return F.transform(F.array_distinct(words), lambda w: F.xxhash64(w))


def _held(found: DataFrame) -> DataFrame:
    """One row per different text with spans: ``row, key, copies, spans, text``."""
    copies = (
        found.where(F.size("spans") > 0)
        .groupBy("key")
        .agg(F.min("row").alias("row"), F.count("*").alias("copies"))
        .select("row", "copies")
    )
    return found.where(F.size("spans") > 0).drop("doc_id").join(copies, "row")


def _text_set(row: str) -> list[Column]:
    """128-bit hash of a set of rows (each row once)."""
    return [
        F.bit_xor(F.xxhash64(row)).alias("a"),
        F.bit_xor(F.xxhash64(F.lit("second"), F.col(row))).alias("b"),
    ]


def _chance(k: Column, n: Column, p: Column) -> Column:
    """Log of Chernoff's bound of ``k`` or more of ``n``, each with chance ``p``."""
    rest = F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - p)))).otherwise(F.lit(0.0))
    return F.when(k > n * p, -(k * F.log(k / (n * p)) + rest)).otherwise(F.lit(0.0))


def disclosing_terms(
    spark: SparkSession,
    docs: DataFrame,
    found: DataFrame,
    min_contexts: int = 3,
    generalise_at: float = 0.8,
    remove_at: float = 0.95,
    max_chance: float = 0.01,
    text_col: str = "text",
) -> DataFrame:
    """``row, h, kind``: disclosing terms (by hash) of the texts of :func:`_held`."""
    total = float(found.count())
    held = _held(found)

    def most(n_entity: Column) -> Column:
        # With n_both <= n_entity, a term of more documents stays below the
        # threshold; one more against rounding.
        return F.lit(total) * F.pow(n_entity / F.lit(total), F.lit(generalise_at)) + 1

    # Entities of at least min_contexts texts; one of each set of texts.
    entities = stored(
        spark,
        held.select(
            "row",
            "copies",
            F.explode(F.array_distinct(F.flatten(F.transform("spans", _entities)))).alias("entity"),
        ),
        "pii-entities",
    )
    entity_sets = stored(
        spark,
        entities.groupBy("entity")
        .agg(F.count("*").alias("texts"), F.sum("copies").alias("n_entity"), *_text_set("row"))
        .where(F.col("texts") >= min_contexts)
        .groupBy("a", "b")
        .agg(F.min("entity").alias("entity"), F.first("n_entity").alias("n_entity")),
        "pii-entity-sets",
    )
    known = entity_sets.agg(F.count("*").alias("n"), F.max(most(F.col("n_entity"))).alias("most"))
    n_entities, widest = known.first()
    entities = stored(
        spark,
        entities.join(entity_sets.select("entity", "n_entity"), "entity"),
        "pii-entities-counted",
    )

    # Documents per term: all words of all texts, less those that stand only
    # in spans.
    outside = _term_hashes(_outside(F.col("text"), F.col("spans")))
    only_in_spans = F.array_except(_term_hashes(F.col("text")), outside)
    everywhere = docs.select(F.explode(_term_hashes(whole(F.col(text_col)))).alias("h"))
    counted = (
        everywhere.select("h", F.lit(1).cast("long").alias("n"))
        .unionByName(
            found.where(F.size("spans") > 0).select(
                F.explode(only_in_spans).alias("h"), F.lit(-1).cast("long").alias("n")
            )
        )
        .groupBy("h")
        .agg(F.sum("n").alias("n_term"))
    )
    terms = stored(spark, held.select("row", F.explode(outside).alias("h")), "pii-terms")
    able = stored(
        spark,
        terms.groupBy("h")
        .agg(F.count("*").alias("texts"), *_text_set("row"))
        .where(F.col("texts") >= min_contexts)
        .join(counted, "h")
        .where(F.col("n_term") <= (widest or 0.0))
        .select("h", "n_term", "a", "b"),
        "pii-terms-able",
    )
    # One term of each set of texts and frequency stands for all of them.
    term_sets = stored(
        spark, able.groupBy("a", "b", "n_term").agg(F.min("h").alias("one")), "pii-term-sets"
    )
    tried = max(n_entities, 1) * max(term_sets.count(), 1)
    terms = stored(
        spark,
        terms.join(term_sets.select(F.col("one").alias("h"), "n_term"), "h"),
        "pii-terms-counted",
    )

    n = F.lit(total)
    pmi = F.log2(F.col("n_both") * n / (F.col("n_entity") * F.col("n_term")))
    ic = F.log2(n / F.col("n_entity"))
    # Different texts with both, and all documents of the term without the entity.
    trials = F.col("texts") + F.col("n_term") - F.col("n_both")
    pairs = (
        entities.join(terms, "row")
        .where(F.col("n_term") <= most(F.col("n_entity")))
        .groupBy("entity", "h")
        .agg(
            F.sum("copies").alias("n_both"),
            F.count("*").alias("texts"),
            F.first("n_entity").alias("n_entity"),
            F.first("n_term").alias("n_term"),
        )
        .where(F.col("texts") >= min_contexts)
        .withColumn("disclosure", F.when(ic > 0, pmi / ic))
        .where(F.col("disclosure") >= generalise_at)
        .where(
            _chance(F.col("texts"), trials, F.col("n_entity") / n) <= math.log(max_chance / tried)
        )
        .select(
            "entity",
            "h",
            F.when(F.col("disclosure") >= remove_at, F.lit(REMOVE)).otherwise(F.lit(GENERAL)).alias(
                "kind"
            ),
        )
    )
    pairs = stored(spark, pairs, "pii-pairs")
    marks = (
        terms.select("row", "h")
        .join(pairs, "h")
        .join(entities.select("row", "entity"), ["row", "entity"])
        .groupBy("row", "h")
        .agg(F.max("kind").alias("kind"))
    )
    members = (
        term_sets.join(pairs.select(F.col("h").alias("one")).distinct(), "one")
        .join(able, ["a", "b", "n_term"])
        .select("one", "h")
    )
    return marks.withColumnRenamed("h", "one").join(members, "one").select("row", "h", "kind")


def _marked(text: Column, spans: Column, found: Column) -> Column:
    """Spans of the terms whose hashes are keys of ``found``, outside ``spans``."""

    def of_part(p: Column) -> Column:
        words = F.split(p["part"], TERM, -1)
        gaps = F.array_append(F.regexp_extract_all(p["part"], F.lit(TERM), F.lit(0)), F.lit(""))
        sized = F.zip_with(
            words, gaps, lambda w, g: F.struct(w.alias("w"), (F.length(w) + F.length(g)).alias("n"))
        )

        def hits(ws: Column, before: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                a = p["at"] + F.get(before, i)
                term = F.lower(x["w"])
                kind = F.try_element_at(found, F.xxhash64(term))
                return F.when(
                    (F.length(x["w"]) >= MIN_TERM) & kind.isNotNull(),
                    F.struct(
                        a.alias("start"),
                        kind.alias("kind"),
                        (a + F.length(x["w"])).alias("end"),
                        term.alias("value"),
                    ),
                )

            return F.filter(F.transform(ws, one), lambda t: t.isNotNull())

        return _let(
            sized,
            lambda ws: _let(
                _before(F.transform(ws, lambda x: x["n"]), _plus), lambda b: hits(ws, b)
            ),
        )

    return F.flatten(F.transform(_clear_parts(text, spans), of_part))


def term_spans(found: DataFrame, disclosing: DataFrame) -> DataFrame:
    """``key, terms``: the spans of disclosing terms, per text."""
    lists = disclosing.groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("h", "kind"))).alias("kinds")
    )
    return found.join(lists, "row").select(
        "key", _marked(F.col("text"), F.col("spans"), F.col("kinds")).cast(SPAN).alias("terms")
    )


def sanitise(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    **thresholds,
) -> DataFrame:
    """``doc_id, spans, all_spans`` per document: pattern spans, and all."""
    found = find(spark, docs, id_col, text_col)
    terms = term_spans(
        found, disclosing_terms(spark, docs, found, text_col=text_col, **thresholds)
    )
    none = F.array().cast(SPAN)
    return found.join(terms, "key", "left").select(
        "doc_id",
        "spans",
        F.array_sort(F.concat("spans", F.coalesce("terms", none))).alias("all_spans"),
    )


def _rewritten(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its class; overlapping spans merge."""
    tokens = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS], F.lit("<TERM>"), F.lit(""))

    def new(pages: Column, s: Column, before: Column) -> Column:
        parts = F.transform(
            s,
            lambda x, i: F.when(
                x["start"] >= F.get(before, i),
                F.concat(_cut(pages, F.get(before, i), x["start"]), F.get(tokens, x["kind"])),
            ),
        )
        end = F.array_max(F.transform(s, lambda x: x["end"]))
        return F.concat(F.array_join(parts, ""), _cut(pages, end, F.length(text)))

    def reached(s: Column) -> Column:
        return _before(F.transform(s, lambda x: x["end"]), F.greatest)

    replaced = _let(
        spans, lambda s: _let(_pages(text), lambda p: _let(reached(s), lambda b: new(p, s, b)))
    )
    return F.when(F.size(spans) > 0, replaced).otherwise(text)


def sanitise_documents(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = "n_chars",
    **thresholds,
) -> DataFrame:
    """``docs`` with all spans replaced; ``length_col``, if there, follows.

    A null text stays null.
    """
    found = find(spark, docs, id_col, text_col)
    terms = term_spans(
        found, disclosing_terms(spark, docs, found, text_col=text_col, **thresholds)
    )
    columns = list(docs.columns)
    packed = docs.select(
        packed_row(docs).alias("row"),
        whole(F.col(text_col)).alias("text"),
        text_key(whole(F.col(text_col))).alias("key"),
    )
    marked = base_spans(packed, "text", "spans").join(terms, "key", "left")
    spans = F.array_sort(F.concat("spans", F.coalesce("terms", F.array().cast(SPAN))))
    new = marked.select("row", "text", spans.alias("spans")).select(
        "row",
        F.when(F.col("row")[text_col].isNotNull(), _rewritten(F.col("text"), F.col("spans"))).alias(
            "text"
        ),
    )

    def value(c: str) -> Column:
        if c == text_col:
            return F.col("text").alias(c)
        if c == length_col:
            kind = docs.schema[c].dataType
            return F.coalesce(F.length("text").cast(kind), F.col("row")[c]).alias(c)
        return F.col("row")[c].alias(c)

    return new.select(*[value(c) for c in columns])
