"""Catalogue operators.

All of these are per-row projections or filters over the catalogue, except
the fallback (two semi joins) and ``head_n`` (a top-k).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigfleet.functions.links import absolute_link, discovered_links, fill_template, link_href, swap_base
from sigfleet.schemas import DETAILED_SUFFIX, PLACEHOLDER_BASE_URL, SIGNAL_CODES


def id_names(pumps: DataFrame) -> DataFrame:
    """``(id, name)``; a missing string value becomes ``''``."""
    def dflt(c, alias):
        col = F.col(c)
        if isinstance(pumps.schema[c].dataType, T.StringType):
            col = F.coalesce(col, F.lit(""))
        return col.alias(alias)

    return pumps.select(dflt("pump_id", "id"), dflt("name", "name"))


def valid_ids(pumps: DataFrame) -> DataFrame:
    """Drop records with no id (null, or ``''`` for text ids)."""
    c = F.col("pump_id")
    cond = c.isNotNull()
    if isinstance(pumps.schema["pump_id"].dataType, T.StringType):
        cond = cond & (c != "")
    return pumps.where(cond)


def name_filter(pumps: DataFrame, parts, match: str = "substring") -> DataFrame:
    """Keep pumps whose name holds any of ``parts`` (case-sensitive).

    ``match='substring'`` is the plain test (``EB1`` also takes ``EB10``);
    ``match='prefix_token'`` compares the first blank-separated token, for
    an exact station. ``parts=None`` keeps every pump.
    """
    if parts is None:
        return pumps
    name = F.col("name")
    if match == "prefix_token":
        token = F.element_at(F.split(name, r"\s+"), 1)
        tests = [token == F.lit(p) for p in parts]
    elif match == "substring":
        tests = [name.contains(F.lit(p)) for p in parts]
    else:
        raise ValueError(f"unknown match mode: {match!r}")
    return pumps.where(reduce(lambda a, b: a | b, tests, F.lit(False)))


def head_n(pumps: DataFrame, n: int | None = None, order: str = "source_pos") -> DataFrame:
    """First ``n`` pumps in source order; ``None`` = the whole fleet.

    ``orderBy().limit()`` plans as a per-partition top-k merged on one task,
    which moves at most ``n`` rows per partition."""
    df = pumps.orderBy(order)
    return df if n is None else df.limit(n)


def signal_keys() -> list[tuple[str, bool]]:
    return [(c, False) for c in SIGNAL_CODES] + [(c, True) for c in SIGNAL_CODES]


def links_workset(pumps: DataFrame, base: str = PLACEHOLDER_BASE_URL) -> DataFrame:
    """Every (pump, signal key, link) fetch to make.

    The 16 keys come from a literal array exploded per pump: a generator
    on the pump rows, no join and no shuffle.
    """
    keys = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(d).alias("detailed")) for c, d in signal_keys()])
    x = pumps.select("pump_id", F.explode(keys).alias("_k"))
    key = F.concat(F.col("_k.code"), F.when(F.col("_k.detailed"), F.lit(DETAILED_SUFFIX)).otherwise(F.lit("")))
    return x.select(
        "pump_id",
        key.alias("signal"),
        fill_template(F.col("pump_id"), F.col("_k.code"), F.col("_k.detailed"), base).alias("href"),
    )


def links_map(pumps: DataFrame, base: str = PLACEHOLDER_BASE_URL) -> DataFrame:
    """Catalogue-shaped link column ``links map<key, '{"href": ...}'>``."""
    entries = []
    for c, d in signal_keys():
        href = fill_template(F.col("pump_id"), F.lit(c), d, base)
        entries.append(F.struct(F.lit(c + (DETAILED_SUFFIX if d else "")), F.to_json(F.struct(href.alias("href")))))
    return pumps.withColumn("links", F.map_from_entries(F.array(*entries)))


def links_count(pumps_with_links: DataFrame) -> DataFrame:
    """F8 + A7: per pump record, the number of link entries holding ``href``.

    Counted inside each record's map (catalogue rows are one per pump after
    :func:`sigfleet.operators.reports.dedupe_last`), so no shuffle.
    """
    n = F.size(discovered_links(F.col("links"))).cast("long")
    return pumps_with_links.select("pump_id", n.alias("links"))


def rewrite_links(df: DataFrame, href: str, when, old_base: str, new_base: str) -> DataFrame:
    """swap the base prefix of the links selected by ``when``."""
    h = F.col(href)
    return df.withColumn(href, F.when(when, swap_base(h, old_base, new_base)).otherwise(h))


def pump_info(
    pumps_with_links: DataFrame, pump_ids, base: str = PLACEHOLDER_BASE_URL, signal: str = "status"
) -> DataFrame:
    """Info record of the chosen pumps with the catalogue's own
    link of one signal (made absolute); no such link -> null."""
    chosen = pumps_with_links.where(F.col("pump_id").isin(list(pump_ids)))
    href = absolute_link(link_href("links", signal), base)
    return chosen.select("pump_id", "name", href.alias(f"{signal}_href"))


def with_fallback(primary: DataFrame, snapshot: DataFrame, outcomes: DataFrame, unit: str) -> DataFrame:
    """Per load unit, primary rows unless that unit's primary load ended
    in ``error``; then the snapshot rows of the unit instead.

    ``outcomes(unit, outcome)`` has one row per load unit (file, partition);
    an unexpected shape or an empty load is *not* an error and does not fall
    back, nor does a unit without an outcome. An anti and a semi join; AQE
    broadcasts ``outcomes`` when it is small.
    """
    failed = outcomes.where(F.col("outcome") == "error").select(unit).distinct()
    keep = primary.join(failed, unit, "left_anti")
    repl = snapshot.join(failed, unit, "left_semi")
    return keep.unionByName(repl)
