import json
import os

from pyspark.sql import functions as F

from sigfleet.operators.catalog_ops import id_names, links_count, name_filter, valid_ids
from sigfleet.schemas import DETAILED_SUFFIX, SIGNAL_CODES
from sigfleet.sources.catalog import (
    catalog_links,
    catalog_with_fallback,
    catalog_with_file_fallback,
    latest_catalog,
    load_outcomes,
    loaded_documents,
    read_catalog,
)

HOST = "https://example.invalid"
BOM = "\ufeff"


def record(i, name=None, drop_key=None, relative=None, with_id=True, pid=None):
    pid = pid or f"00000000-0000-0000-0000-{i:012d}"
    rec = {}
    for code in SIGNAL_CODES:
        for key in (code, code + DETAILED_SUFFIX):
            rec[key] = {"href": f"{HOST}/{pid}/{key}/"}
    if drop_key:
        del rec[drop_key]
    if relative:
        rec[relative] = {"href": f"/{pid}/{relative}/"}
    if with_id is True:
        rec["id"] = pid
    elif with_id == "":
        rec["id"] = ""
    if name is not None:
        rec["name"] = name
    return rec


def write(path, obj, bom=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = json.dumps(obj, indent=4)
    with open(path, "w", encoding="utf-8") as f:
        f.write((BOM if bom else "") + text)


def fleet(n=60):
    # Names "north<station> u<unit>", ordered by id, not by name.
    return [record(i, f"north{i % 25} u{i % 4 + 1}") for i in range(n)]


def test_scan_bare_array_with_bom(spark, tmp):
    write(f"{tmp}/cat/a.json", fleet())
    df = read_catalog(spark, f"{tmp}/cat")
    assert df.count() == 60
    assert df.select(F.sum(F.size("links"))).first()[0] == 60 * 16
    assert [r.source_pos for r in df.orderBy("source_pos").limit(3).collect()] == [0, 1, 2]


def test_bad_records_cost_only_themselves(spark, tmp):
    write(f"{tmp}/cat/a.json", [record(0, "north1 u1"), 5, None, "x", [1], record(1, "north1 u2")])
    assert [r.name for r in read_catalog(spark, f"{tmp}/cat").collect()] == ["north1 u1", "north1 u2"]


def test_scan_envelope_and_other_shapes(spark, tmp):
    write(f"{tmp}/env/a.json", {"results": fleet(5)}, bom=False)
    write(f"{tmp}/other/a.json", {"items": fleet(5)})
    write(f"{tmp}/scalar/a.json", 3)
    assert read_catalog(spark, f"{tmp}/env").count() == 5
    assert read_catalog(spark, f"{tmp}/other").count() == 0
    assert read_catalog(spark, f"{tmp}/scalar").count() == 0
    assert read_catalog(spark, f"{tmp}/missing").count() == 0


def test_link_discovery_and_count(spark, tmp):
    recs = [record(0, "south3 u4"), record(1, "south3 u1", drop_key="speed/detailed")]
    recs[0]["note"] = "plain text, not a link"
    write(f"{tmp}/cat/a.json", recs)
    cat = read_catalog(spark, f"{tmp}/cat")
    counts = {r.pump_id[-1]: r.links for r in links_count(cat).collect()}
    assert counts == {"0": 16, "1": 15}
    long = catalog_links(cat)
    assert long.count() == 31
    assert long.where("detailed").count() == 15


def test_missing_fields_defaults_and_valid_ids(spark, tmp):
    recs = [record(0, "north1 u1"), record(1, None), record(2, "south2 u1", with_id=False), record(3, "south2 u2", with_id="")]
    write(f"{tmp}/cat/a.json", recs)
    cat = read_catalog(spark, f"{tmp}/cat")
    assert valid_ids(cat).count() == 2
    names = {r.name for r in id_names(cat).collect()}
    assert "" in names  # missing name -> ''


def test_repeated_id_last_wins(spark, tmp):
    pid = "00000000-0000-0000-0000-00000000000a"
    recs = [record(0, "first", pid=pid), record(1, "other"), record(2, "last", pid=pid)]
    write(f"{tmp}/cat/a.json", recs)
    latest = latest_catalog(read_catalog(spark, f"{tmp}/cat"))
    assert latest.count() == 2
    assert latest.where(F.col("pump_id") == pid).first().name == "last"


def test_name_filter_substring_and_token(spark, tmp):
    write(f"{tmp}/cat/a.json", fleet())
    cat = read_catalog(spark, f"{tmp}/cat")
    sub = name_filter(cat, ["north1"]).count()
    tok = name_filter(cat, ["north1"], match="prefix_token").count()
    exact = cat.where(F.col("name").startswith("north1 ")).count()
    many = cat.where(F.col("name").contains("north1")).count()
    assert sub == many and tok == exact and tok < sub
    assert name_filter(cat, None).count() == 60


def test_fallback_only_when_primary_unreadable(spark, tmp):
    write(f"{tmp}/snap/a.json", fleet(4))
    write(f"{tmp}/prim/a.json", fleet(2))
    write(f"{tmp}/empty/a.json", [])
    assert {r.origin for r in catalog_with_fallback(spark, f"{tmp}/prim", f"{tmp}/snap").collect()} == {"primary"}
    fb = catalog_with_fallback(spark, f"{tmp}/nothing-here", f"{tmp}/snap")
    assert fb.count() == 4 and {r.origin for r in fb.collect()} == {"snapshot"}
    # An empty primary list is an answer, not a failure.
    assert catalog_with_fallback(spark, f"{tmp}/empty", f"{tmp}/snap").count() == 0


def test_pump_type_default_and_link_lookup(spark, tmp):
    from sigfleet.functions.links import link_href, publication_link

    recs = [record(0, "south3 u4"), record(1, "south3 u1")]
    recs[1]["type"] = "Booster"
    write(f"{tmp}/cat/a.json", recs)
    cat = read_catalog(spark, f"{tmp}/cat").orderBy("source_pos")
    rows = cat.select(
        "pump_type",
        link_href("links", "onoffschedule").alias("h"),
        link_href("links", "nope").alias("missing"),
        publication_link(link_href("links", "onoffschedule"), F.col("pump_id"), HOST).alias("pub"),
    ).collect()
    assert [r.pump_type for r in rows] == ["Physical Pump", "Booster"]
    pid = "00000000-0000-0000-0000-000000000000"
    assert rows[0].h == f"{HOST}/{pid}/onoffschedule/" and rows[0].missing is None
    # the id already in the link is not repeated
    assert rows[0].pub == f"{HOST}/publication/physicalPumps/{pid}/onoffschedule/"


def test_id_names_csv_keeps_catalogue_pairs_and_order(spark, tmp):
    import csv
    import glob as _glob

    from sigfleet.sinks.writers import write_csv

    recs = fleet()
    write(f"{tmp}/cat/a.json", recs)
    cat = read_catalog(spark, f"{tmp}/cat").orderBy("source_file", "source_pos")
    write_csv(id_names(cat), f"{tmp}/ids")
    rows = []
    for part in sorted(_glob.glob(f"{tmp}/ids/part-*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            rows += [(r["id"], r["name"]) for r in csv.DictReader(f)]
    assert rows == [(r["id"], r["name"]) for r in recs]


def test_fallback_file_by_file(spark, tmp):
    import gzip

    for i in range(8):
        write(f"{tmp}/snap/region/{i}.json", [record(10 + i, f"old{i}")])
    prim = f"{tmp}/prim/region"
    write(f"{prim}/0.json", [record(0, "new0")])
    write(f"{prim}/1.json", [])  # an answer without records
    write(f"{prim}/2.json", {"unexpected": 1})  # another shape: an answer too
    whole = json.dumps([record(3, "new3")])
    for name, text in (("3", whole[:-1]), ("4", whole + "]"), ("5", "")):
        with open(f"{prim}/{name}.json", "w", encoding="utf-8") as f:
            f.write(text)
    # 6 is missing; 8 is a compressed file that breaks off.
    write(f"{prim}/7.json", [record(7, "new7")])
    with open(f"{prim}/8.json.gz", "wb") as f:
        f.write(gzip.compress(json.dumps([record(8, "new8")]).encode() * 50)[:-20])
    write(f"{tmp}/snap/region/9.json", [record(19, "old9")])
    with open(f"{tmp}/snap/region/8.json.gz", "wb") as f:
        f.write(gzip.compress(json.dumps([record(18, "old8")]).encode()))

    got = catalog_with_file_fallback(spark, f"{tmp}/prim", f"{tmp}/snap")
    rows = {(r.file, r.name, r.origin) for r in got.collect()}
    stand_in = {(f"region/{i}.json", f"old{i}", "snapshot") for i in (3, 4, 5, 6, 9)}
    assert rows == stand_in | {
        ("region/0.json", "new0", "primary"),
        ("region/7.json", "new7", "primary"),
        ("region/8.json.gz", "old8", "snapshot"),
    }
    docs = loaded_documents(spark, f"{tmp}/prim")
    names = docs.select("file").union(spark.createDataFrame([("region/6.json",), ("region/8.json.gz",)], "file string"))
    outcomes = {r.file[7]: r.outcome for r in load_outcomes(docs, names).collect()}
    assert outcomes == {"0": "ok", "1": "empty", "2": "empty", "3": "error", "4": "error", "6": "error", "7": "ok", "8": "error"}
    # A primary folder that is not there at all: every file falls back.
    gone = catalog_with_file_fallback(spark, f"{tmp}/nowhere", f"{tmp}/snap")
    assert gone.count() == 10 and {r.origin for r in gone.select("origin").distinct().collect()} == {"snapshot"}
    assert catalog_with_file_fallback(spark, f"{tmp}/nowhere", f"{tmp}/nowhere").count() == 0
