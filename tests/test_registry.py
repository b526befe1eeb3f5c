"""Registry XML: file scan, nesting, record names, quarantine split and sink."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from firmlink.plans.stage_registry import RECORD_FIELDS, stage_registry
from firmlink.sources.registry_xml import flatten_registry, parse_registry_xml, read_registry_xml
from firmlink.sources.tables import write_quarantine
from tests.conftest import SF001

ORD = ["_file", "_block", "_row"]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_xml_round_trip_from_customer(spark, tmpdir_fresh):
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    src = cust.select(
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("ABN"),
        F.col("c_name").alias("NonIndividualNameText"),
        F.col("c_mktsegment").alias("EntityTypeText"),
        F.lpad((F.col("c_nationkey") * 100).cast("string"), 4, "0").alias("Postcode"),
    )
    out = os.path.join(tmpdir_fresh, "xml")
    src.write.format("xml").option("rowTag", "ABR").option("rootTag", "Transfer").save(out)
    flat = flatten_registry(read_registry_xml(spark, out), keep=ORD)
    load = stage_registry(flat, ORD, audit=False)
    got = {(r.abn, r.entity_name, r.entity_type, r.postcode) for r in load.inserted.collect()}
    want = {tuple(r) for r in src.collect()}
    assert got == want and len(got) == cust.count()
    assert any(p.startswith("0") for _, _, _, p in got)  # leading zeros kept
    assert load.quarantine.count() == 0


XML = """<?xml version="1.0"?>
<Transfer xmlns:n="urn:abr">
<ABR><ABN>001</ABN><NonIndividualNameText>   </NonIndividualNameText><OrganisationName>Org One</OrganisationName>
  <EntityTypeText></EntityTypeText><EntityType>PRV</EntityType><ABNStatus>  </ABNStatus>
  <Postcode>   </Postcode><StartDate>20240105</StartDate></ABR>
<ABR><EntityTypeText>IND</EntityTypeText><State>NSW</State></ABR>
<n:ABR><n:ABN>002</n:ABN><n:EntityName>Namespaced</n:EntityName><n:ABNStatusFromDate>2020-02-03Z</n:ABNStatusFromDate></n:ABR>
<ABR><ABN>001</ABN><EntityName>Duplicate later</EntityName></ABR>
<ABR><EntityName>No number 1</EntityName></ABR>
<ABR><EntityName>No number 2</EntityName></ABR>
</Transfer>
"""


def test_flatten_fallbacks_quarantine_and_keep_first(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "abr.xml")
    _write(path, XML)
    flat = flatten_registry(read_registry_xml(spark, path), keep=ORD)
    load = stage_registry(flat, ORD, audit=False)
    rows = {r.entity_name: r for r in load.inserted.collect()}
    assert set(rows) == {"Org One", "Namespaced", "No number 1", "No number 2"}
    one = rows["Org One"]
    assert (one.abn, one.entity_type, one.entity_status, one.postcode, one.start_date) == (
        "001", "PRV", None, "", dt.date(2024, 1, 5))
    assert rows["Namespaced"].start_date == dt.date(2020, 2, 3)
    q = load.quarantine.collect()
    assert [(r.reason, r.state) for r in q] == [("missing_key_fields", "NSW")]
    metrics = {r.metric: r.value for r in load.metrics.collect()}
    assert metrics == {"registry_parsed": 6, "registry_quarantined": 1, "registry_inserted": 4}

    qdir = os.path.join(tmpdir_fresh, "quarantine")
    write_quarantine(load.quarantine, qdir, record_cols=RECORD_FIELDS)
    files = glob.glob(os.path.join(qdir, "reason=missing_key_fields", "*.json"))
    recs = [json.loads(line) for f in files for line in open(f, encoding="utf-8")]
    assert len(recs) == 1 and recs[0]["error"] == "missing_key_fields"
    assert recs[0]["record"]["state"] == "NSW" and recs[0]["record"]["entity_type"] == "IND"
    assert len(recs[0]["quarantine_time"]) == 16 and recs[0]["quarantine_time"].endswith("Z")


def test_malformed_record_goes_to_quarantine(spark):
    df = spark.createDataFrame(
        [(1, "<ABR><ABN>1</ABN><EntityName>A & B</EntityName></ABR>"),
         (2, "<ABR><ABN>2</ABN><EntityName>A &amp; B</EntityName></ABR>")], "k long, xml string")
    flat = flatten_registry(parse_registry_xml(df, "xml"), keep=["k"])
    load = stage_registry(flat, ["k"], audit=False)
    assert [(r.k, r.reason) for r in load.quarantine.collect()] == [(1, "parse_failed")]
    assert [(r.abn, r.entity_name) for r in load.inserted.collect()] == [("2", "A & B")]
    kept = stage_registry(flat, ["k"], keep_partial=True, audit=False)
    assert kept.quarantine.count() == 0


BULK = """<Transfer>
<ABR recordLastUpdatedDate="20240101" replaced="N">
  <ABN status="ACT" ABNStatusFromDate="19991101">53004085616</ABN>
  <EntityType><EntityTypeInd>PUB</EntityTypeInd><EntityTypeText>Australian Public Company</EntityTypeText></EntityType>
  <MainEntity><NonIndividualName type="MN"><NonIndividualNameText>WIDGETS LIMITED</NonIndividualNameText></NonIndividualName>
    <BusinessAddress><AddressDetails><State>NSW</State><Postcode>2153</Postcode></AddressDetails></BusinessAddress>
  </MainEntity>
</ABR>
<ABR recordLastUpdatedDate="20240101" replaced="N">
  <ABN status="CAN" ABNStatusFromDate="20010101">11111111111</ABN>
  <EntityType><EntityTypeInd>IND</EntityTypeInd><EntityTypeText>Individual/Sole Trader</EntityTypeText></EntityType>
  <LegalEntity><IndividualName type="LGL"><GivenName>JO</GivenName><FamilyName>SMITH</FamilyName></IndividualName>
    <BusinessAddress><AddressDetails><State>VIC</State><Postcode>3000</Postcode></AddressDetails></BusinessAddress>
  </LegalEntity>
</ABR>
</Transfer>"""


def test_bulk_extract(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "bulk.xml")
    _write(path, BULK)
    flat = flatten_registry(read_registry_xml(spark, path), keep=ORD)
    load = stage_registry(flat, ORD, audit=False)
    rows = sorted((r.abn, r.entity_name, r.entity_type, r.state, r.postcode, r.entity_status)
                  for r in load.inserted.collect())
    assert rows == [
        ("11111111111", None, "Individual/Sole Trader", "VIC", "3000", None),
        ("53004085616", "WIDGETS LIMITED", "Australian Public Company", "NSW", "2153", None),
    ]


MIXED = """<Transfer>
<ABR><ABN>00012</ABN><NonIndividualNameText>Flat Co</NonIndividualNameText><Postcode>0200</Postcode></ABR>
<ABR recordLastUpdatedDate="20240101">
  <ABN status="ACT">53004085616</ABN>
  <EntityType><EntityTypeInd>PUB</EntityTypeInd><EntityTypeText>Public Company</EntityTypeText></EntityType>
  <MainEntity><NonIndividualName type="MN"><NonIndividualNameText>Nested Ltd</NonIndividualNameText></NonIndividualName>
    <BusinessAddress><AddressDetails><State>NSW</State><Postcode>2153</Postcode></AddressDetails></BusinessAddress>
  </MainEntity>
  <OtherEntity><NonIndividualName><NonIndividualNameText>Trading Name A</NonIndividualNameText></NonIndividualName></OtherEntity>
  <OtherEntity><NonIndividualName><NonIndividualNameText>Trading Name B</NonIndividualNameText></NonIndividualName></OtherEntity>
</ABR>
</Transfer>"""


def test_fields_at_any_depth(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "mixed.xml")
    _write(path, MIXED)
    flat = flatten_registry(read_registry_xml(spark, path), keep=ORD)
    rows = sorted((r.abn, r.entity_name, r.entity_type, r.postcode, r.state)
                  for r in stage_registry(flat, ORD, audit=False).inserted.collect())
    assert rows == [
        ("00012", "Flat Co", None, "0200", None),
        ("53004085616", "Nested Ltd", "Public Company", "2153", "NSW"),
    ]


def test_record_names_in_any_case(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "tags.xml")
    _write(path, "<T><ABR><ABN>1</ABN><EntityName>One</EntityName></ABR>"
                 "<entity><ABN>2</ABN><EntityName>Two</EntityName></entity>"
                 "<abr\n a='1'><ABN>3</ABN><OtherEntity><EntityName><![CDATA[Three & Co]]></EntityName></OtherEntity></abr>"
                 "<z:Record xmlns:z='u'><z:ABN>4</z:ABN><z:EntityName>F&#111;ur</z:EntityName></z:Record >"
                 "<EntityRecord/><Entities><ABN>9</ABN></Entities></T>")
    flat = flatten_registry(read_registry_xml(spark, path), keep=ORD)
    rows = sorted((r.abn, r.entity_name) for r in stage_registry(flat, ORD, audit=False).inserted.collect())
    assert rows == [("1", "One"), ("2", "Two"), ("3", "Three & Co"), ("4", "Four")]


def test_records_cross_file_blocks(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "big.xml")
    _write(path, "<T>" + "".join(
        f"<ABR><ABN>{i}</ABN><X>{'x ' * (i % 50)}</X><MainEntity><EntityName>Name {i}</EntityName></MainEntity></ABR>" for i in range(3000)) + "</T>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = read_registry_xml(spark, path)
        flat = flatten_registry(records, keep=ORD).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({r["_block"] for r in flat}) > 5
    in_order = sorted(flat, key=lambda r: [r[c] for c in ORD])
    assert [(r.abn, r.entity_name, r.parse_failed) for r in in_order] == [(str(i), f"Name {i}", False) for i in range(3000)]


def test_parse_reads_the_source_once(spark):
    df = spark.createDataFrame([(1, "<ABR><ABN>1</ABN></ABR>")], "k long, xml string")
    plan = flatten_registry(parse_registry_xml(df), keep=["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_xml") <= 1


def test_records_of_one_partition_are_parsed_by_several_tasks(spark):
    one = spark.range(0, 4000, 1, 1).select("id", F.format_string("<ABR><ABN>%011d</ABN></ABR>", "id").alias("xml"))
    assert one.rdd.getNumPartitions() == 1
    flat = flatten_registry(parse_registry_xml(one), keep=["id"])
    tasks = flat.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 1 and max(t["count"] for t in tasks) < 4000 / 2
    assert {(r.id, r.abn) for r in flat.select("id", "abn").collect()} == {(k, f"{k:011d}") for k in range(4000)}
