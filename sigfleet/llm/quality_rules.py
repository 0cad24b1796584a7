"""Quality rules as a learned decision list.

Sequential covering over labelled documents: grow a conjunction of threshold
conditions that describes rejected documents, prune it on rows kept apart,
accept it if it is precise there, remove the rows it covers, repeat. The
result is an ordered list of rules, applied as one ``CASE WHEN`` expression,
so scoring is a projection without a shuffle.

Every step of the search is one grouped count over binned statistics; the
driver sees ``features x bins`` counts and never a row. Fitting reads at most
``max_labelled`` labelled documents (chosen by hash of the id), as documented
on :func:`labelled_sample`; statistics and decisions cover every document.

Defined cases: a null or blank text has no words, so it fails the base rule;
ratios over zero words are 0; a null label, or a document whose repeated
label rows disagree, is not used for fitting; without usable labels of both
classes the list is empty and only the base rule decides.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.llm.common import count_chars, packed_row, stored, unpacked, whole, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

FEATURES = [
    "f_words",
    "f_word_len",
    "f_symbols",
    "f_dup_lines",
    "f_repeats",
    "f_upper",
    "f_exclaim",
    "f_digits",
    "f_line_words",
]


def document_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus a struct column ``qstat`` of counts and ratios.

    An input column of that name is replaced.
    """
    other = [F.col(f"`{c}`") for c in docs.columns if c != "qstat"]
    text = whole(F.col(text_col))
    base = docs.select(
        *other,
        F.struct(
            word_array(F.col(text_col)).alias("w"),
            F.split(text, "\n").alias("lines"),
            F.length(F.translate(text, "\x20\x09\x0a\x0b\x0c\x0d", "")).alias("word_chars"),
            count_chars(text, SYMBOLS).alias("n_symbols"),
            count_chars(text, UPPER).alias("n_upper"),
            count_chars(text, "!").alias("n_exclaim"),
            count_chars(text, "0123456789").alias("n_digits"),
        ).alias("qstat"),
    )
    kept = [c for c in base.columns if c != "qstat"]
    q = F.col("qstat")

    def step(df: DataFrame, drop: tuple = (), **new: Column) -> DataFrame:
        fields = [f for f in df.schema["qstat"].dataType.names if f not in drop and f not in new]
        return df.select(
            *[F.col(f"`{c}`") for c in kept],
            F.struct(
                *[q[f].alias(f) for f in fields], *[v.alias(k) for k, v in new.items()]
            ).alias("qstat"),
        )

    n = F.size(q["w"])
    df = step(
        base,
        drop=("w", "lines"),
        n_words=n.cast("long"),
        hashes=F.transform(q["w"], lambda x: F.xxhash64(x)),
        full_lines=F.filter(q["lines"], lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    )
    df = step(
        df,
        drop=("hashes", "full_lines"),
        n_lines=F.size(q["full_lines"]).cast("long"),
        n_dup_lines=(
            F.size(q["full_lines"]) - F.size(F.array_distinct(q["full_lines"]))
        ).cast("long"),
        windows=F.when(
            q["n_words"] >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(q["hashes"]) - WINDOW, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(q["hashes"], i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<long>")),
    )
    # Only texts with a repeated window pay for the sort.
    df = step(
        df,
        drop=("windows",),
        some=F.when(F.size(F.array_distinct(q["windows"])) < F.size(q["windows"]), q["windows"]),
    )
    df = step(
        df,
        drop=("some",),
        pairs=F.array_sort(
            F.transform(q["some"], lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        ),
    )
    df = step(
        df,
        drop=("pairs",),
        places=F.array_sort(
            F.transform(
                F.filter(
                    F.transform(
                        q["pairs"],
                        lambda p, k: F.struct(
                            p["i"].alias("i"),
                            (
                                F.coalesce(p["h"] == F.get(q["pairs"], k - 1)["h"], F.lit(False))
                                | F.coalesce(p["h"] == F.get(q["pairs"], k + 1)["h"], F.lit(False))
                            ).alias("t"),
                        ),
                    ),
                    lambda p: p["t"],
                ),
                lambda p: p["i"],
            )
        ),
    )
    df = step(
        df,
        drop=("places",),
        n_repeat_words=F.coalesce(
            F.aggregate(
                F.transform(
                    q["places"],
                    lambda p, k: F.least(
                        F.coalesce(F.get(q["places"], k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)
                    ),
                ),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            ),
            F.lit(0).cast("long"),
        ),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")

    return step(
        df,
        f_words=q["n_words"].cast("double"),
        f_word_len=ratio(q["word_chars"], q["n_words"]),
        f_symbols=ratio(q["n_symbols"], q["word_chars"]),
        f_dup_lines=ratio(q["n_dup_lines"], q["n_lines"]),
        f_repeats=ratio(q["n_repeat_words"], q["n_words"]),
        f_upper=ratio(q["n_upper"], q["word_chars"]),
        f_exclaim=ratio(q["n_exclaim"], q["n_words"]),
        f_digits=ratio(q["n_digits"], q["word_chars"]),
        f_line_words=ratio(q["n_words"], q["n_lines"]),
    )


def base_failed(stat: Column) -> Column:
    """The fixed base rule: too few words, or too many repeated ones."""
    return (stat["n_words"] < 10) | (100 * stat["n_repeat_words"] > 20 * stat["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stat: Column) -> Column:
        f = stat[self.feature]
        return f > F.lit(self.threshold) if self.above else f <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


@dataclass(frozen=True)
class Rule:
    """Reject when all conditions hold."""

    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def column(self, stat: Column) -> Column:
        return reduce(lambda a, b: a & b, [c.column(stat) for c in self.conditions])

    def __str__(self) -> str:
        return "reject if " + " and ".join(map(str, self.conditions))


def decision(rules: list[Rule], stat: Column) -> Column:
    """The ordered list as one expression: true keeps the document."""
    out = None
    for r in rules:
        out = (F if out is None else out).when(r.column(stat), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fired_rule(rules: list[Rule], stat: Column) -> Column:
    """Number (from 1) of the first rule that rejects, null if none does."""
    out = None
    for k, r in enumerate(rules, 1):
        out = (F if out is None else out).when(r.column(stat), F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = 20_000,
    id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """Statistics of at most ``max_labelled`` labelled documents.

    Columns: ``good`` (label 1), ``prune`` (kept apart for pruning, a third)
    and the features. The labels are cut by hash order before the texts are
    read, so fitting costs the same at every size of the corpus.
    """
    chosen = (
        labels.select(F.col(id_col).alias("lid"), F.col(label_col).alias("lab"))
        .where("lid is not null and lab is not null")
        .groupBy("lid")
        .agg(F.min("lab").alias("lo"), F.max("lab").alias("hi"))
        .where("lo = hi")
        .select("lid", (F.col("lo") == 1).alias("good"))
        .orderBy(F.xxhash64("lid"), "lid")
        .limit(max_labelled)
    )
    # At most max_labelled (id, flag) rows: a proven bound for the broadcast.
    texts = docs.select(F.col(id_col).alias("lid"), F.col("text")).join(
        F.broadcast(chosen), "lid"
    )
    stat = F.col("qstat")
    return document_statistics(texts).select(
        "good",
        (F.pmod(F.xxhash64(F.lit("prune"), "lid"), F.lit(3)) == 0).alias("prune"),
        F.struct(*[stat[f].alias(f) for f in FEATURES]).alias("qstat"),
    )


def _thresholds(sample: DataFrame, bins: int) -> dict[str, list[float]]:
    """Cut points per feature: quantiles within each class."""
    q = [i / bins for i in range(bins)] + [0.99, 1.0]
    rows = (
        sample.groupBy("good")
        .agg(
            *[
                F.percentile_approx(F.col("qstat")[f], q, 10_000).alias(f)
                for f in FEATURES
            ]
        )
        .collect()
    )
    return {f: sorted({float(x) for r in rows for x in (r[f] or [])}) for f in FEATURES}


def _bin(value: Column, cuts: list[float]) -> Column:
    """Index of the smallest cut at or above the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value))


def learn_rules(
    sample: DataFrame,
    bins: int = 24,
    max_rules: int = 8,
    max_conditions: int = 3,
    min_covered: int = 10,
    min_precision: float = 0.99,
) -> list[Rule]:
    """Sequential covering for the class ``good = false``.

    ``sample`` must be a stored table of :func:`labelled_sample` rows. Each
    rule is grown by the gain of its best condition on the growing rows,
    pruned to the prefix that scores best on the pruning rows, and accepted
    if it covers ``min_covered`` rejected rows at ``min_precision``. The
    first rule that is not accepted ends the list.
    """
    cuts = _thresholds(sample, bins)
    if not any(cuts.values()):
        return []
    stat = F.col("qstat")
    binned = F.array(
        *[
            F.struct(
                F.lit(i).alias("f"), _bin(stat[f], cuts[f]).alias("b"), stat[f].cast("double").alias("v")
            )
            for i, f in enumerate(FEATURES)
            if cuts[f]
        ]
    )
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = sample.where(decision(rules, stat))
        conditions: list[Condition] = []
        while len(conditions) < max_conditions:
            rows = left.where(~F.col("prune"))
            if conditions:
                rows = rows.where(Rule(tuple(conditions), 0, 0).column(stat))
            counts = (
                rows.select("good", F.explode(binned).alias("x"))
                .groupBy("x.f", "x.b")
                .agg(
                    F.count_if(~F.col("good")).alias("bad"),
                    F.count_if(F.col("good")).alias("good"),
                    F.min("x.v").alias("low"),
                    F.max("x.v").alias("high"),
                )
                .collect()
            )  # features x bins rows
            best = _best_condition(counts, cuts, min_covered)
            if best is None:
                break
            conditions.append(best)
        if not conditions:
            break
        rule = _pruned(left, conditions, stat)
        if rule.covered < min_covered or rule.precision < min_precision:
            break
        rules.append(rule)
    return rules


def _best_condition(counts, cuts, min_covered) -> Condition | None:
    """The condition of most gain; of equal ones that with the widest gap.

    A condition cuts between two neighbouring values of the sample, in the
    middle of their gap: a threshold on a value itself would turn away what
    lies just beyond the sample's extremes. The gap counts relative to the
    feature's spread.
    """
    from math import log2

    per: dict[int, dict[int, tuple]] = {}
    for r in counts:
        per.setdefault(r["f"], {})[r["b"]] = (r["bad"], r["good"], r["low"], r["high"])
    best, gain, width = None, 1e-9, 0.0
    for f, hist in sorted(per.items()):
        p0, n0 = (sum(v[k] for v in hist.values()) for k in (0, 1))
        if not p0 or not n0:
            return None  # nothing left to separate
        name, p, n = FEATURES[f], 0, 0
        bins = sorted(hist)
        spread = hist[bins[-1]][3] - hist[bins[0]][2]
        for b, after in zip(bins, bins[1:], strict=False):
            p, n = p + hist[b][0], n + hist[b][1]
            below, above_it = hist[b][3], hist[after][2]
            middle, gap = (below + above_it) / 2, (above_it - below) / spread
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                if pp < min_covered:
                    continue
                g = pp * (log2((pp + 1) / (pp + nn + 2)) - log2((p0 + 1) / (p0 + n0 + 2)))
                if g > gain + 1e-9 or (g > gain - 1e-9 and gap > width):
                    best, gain, width = Condition(name, above, middle), max(g, gain), gap
    return best


def _pruned(left: DataFrame, conditions: list[Condition], stat: Column) -> Rule:
    """The prefix of the conjunction that scores best on the pruning rows."""
    aggs = []
    for k in range(1, len(conditions) + 1):
        c = Rule(tuple(conditions[:k]), 0, 0).column(stat)
        for name, part in (("p", F.col("prune")), ("a", F.lit(True))):
            aggs.append(F.count_if(part & c & ~F.col("good")).alias(f"{name}_bad{k}"))
            aggs.append(F.count_if(part & c & F.col("good")).alias(f"{name}_good{k}"))
    row = left.agg(*aggs).first()
    value = {
        k: (row[f"p_bad{k}"] - row[f"p_good{k}"]) / max(1, row[f"p_bad{k}"] + row[f"p_good{k}"])
        for k in range(1, len(conditions) + 1)
    }
    k = min(value, key=lambda k: (-value[k], k))
    bad, good = row[f"a_bad{k}"], row[f"a_good{k}"]
    return Rule(tuple(conditions[:k]), bad / max(1, bad + good), bad)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, **how) -> list[Rule]:
    """Learn the list from ``labels(doc_id, quality)``."""
    size = {k: how.pop(k) for k in ("max_labelled",) if k in how}
    sample = stored(spark, labelled_sample(docs, labels, **size), "quality-sample")
    return learn_rules(sample, **how)


def score(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``docs`` plus ``qstat`` and ``qrule``: base verdict, rule and ``kept``."""
    df = document_statistics(docs, text_col)
    q = F.col("qstat")
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("qstat", "qrule")]
    return df.select(
        *rest,
        "qstat",
        F.struct(
            base_failed(q).alias("base_failed"),
            fired_rule(rules, q).alias("rule"),
            (~base_failed(q) & decision(rules, q)).alias("kept"),
        ).alias("qrule"),
    )


def filter_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the base rule and the learned list keep."""
    packed = docs.select(packed_row(docs).alias("doc"), F.col("text"))
    scored = score(packed, fit(spark, docs, labels))
    # A plain filter would be pushed below the projections and compute the
    # statistics within the predicate once more; a generator is not crossed.
    verdict = F.explode_outer(F.when(F.col("qrule")["kept"], F.array(F.lit(True))))
    return (
        scored.select("doc", verdict.alias("kept"))
        .where("kept")
        .select(*unpacked("doc", docs.columns))
    )
