"""Signal keys and catalogue links (F6-F10) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigfleet.schemas import (
    DETAILED_SIGNAL_TEMPLATE,
    PUBLICATION_PATH,
    DETAILED_SUFFIX,
    ENDPOINTS,
    PLACEHOLDER_BASE_URL,
    SIGNAL_TEMPLATE,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def signal_key(signal, detailed) -> Column:
    """link key of a signal: ``code`` or ``code/detailed``."""
    d = detailed if isinstance(detailed, Column) else F.lit(bool(detailed))
    return F.concat(_col(signal), F.when(d, F.lit(DETAILED_SUFFIX)).otherwise(F.lit("")))


def endpoint_signals(endpoint: str) -> tuple[tuple[str, ...], bool]:
    """Menu endpoint name -> (signal codes, detailed).

    An unknown name raises, as the menu answers "not implemented".
    """
    try:
        return ENDPOINTS[endpoint]
    except KeyError:
        raise ValueError(f"endpoint not implemented: {endpoint!r}") from None


def link_href(links, key: str) -> Column:
    """``links[key].href``; absent key or no ``href`` -> null."""
    return F.get_json_object(F.try_element_at(_col(links), F.lit(key)), "$.href")


def discovered_links(links) -> Column:
    """F8: only the entries whose value is an object holding ``href``,
    as ``map<key, href>``."""
    hrefs = F.transform_values(_col(links), lambda k, v: F.get_json_object(v, "$.href"))
    return F.map_filter(hrefs, lambda k, v: v.isNotNull())


def fill_template(pump_id, signal, detailed=False, base: str = PLACEHOLDER_BASE_URL) -> Column:
    """absolute link of one signal of one pump from the URL template."""
    d = detailed if isinstance(detailed, Column) else F.lit(bool(detailed))
    tmpl = F.when(d, F.lit(DETAILED_SIGNAL_TEMPLATE)).otherwise(F.lit(SIGNAL_TEMPLATE))
    path = F.replace(
        F.replace(tmpl, F.lit("{bmb_id}"), _col(pump_id).cast("string")),
        F.lit("{signal}"),
        _col(signal),
    )
    return F.concat(F.lit(base.rstrip("/")), path)


def absolute_link(href, base: str = PLACEHOLDER_BASE_URL) -> Column:
    """relative link -> absolute under ``base``; absolute links unchanged."""
    h = _col(href)
    joined = F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(h, "^/+", ""))
    return F.when(h.startswith("http"), h).otherwise(joined)


def swap_base(href, old_base: str, new_base: str) -> Column:
    """replace one base prefix by another (schedule links)."""
    return F.replace(_col(href), F.lit(old_base), F.lit(new_base))


def publication_link(href, pump_id, base: str = PLACEHOLDER_BASE_URL) -> Column:
    """F10 for schedule signals: move a catalogue link under the publication
    base ``<base>/publication/physicalPumps/<id>``. Catalogue links already
    hold the pump id after the base, so the id is added only when it is
    absent (the client added it twice)."""
    h = _col(href)
    b = base.rstrip("/")
    pid = _col(pump_id).cast("string")
    holds_id = h.startswith(F.concat(F.lit(b + "/"), pid, F.lit("/")))
    pub = F.lit(b + PUBLICATION_PATH)
    target = F.when(holds_id, pub).otherwise(F.concat(pub, F.lit("/"), pid))
    return F.replace(h, F.lit(b), target)
