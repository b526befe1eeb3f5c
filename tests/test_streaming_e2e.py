"""Incremental crawl loads with Structured Streaming, and the end-to-end job."""

import json
import os


from firmlink.config import MatchConfig
from firmlink.plans.run_all import run_all
from firmlink.streaming import crawl_hits_stream, registry_xml_stream


def _hits(dir_, name, urls):
    os.makedirs(dir_, exist_ok=True)
    with open(os.path.join(dir_, name), "w") as fh:
        for u in urls:
            fh.write(json.dumps({"url": u}) + "\n")


def test_stream_batches_are_insert_if_absent(spark, tmpdir_fresh):
    hits_dir = os.path.join(tmpdir_fresh, "hits")
    target = os.path.join(tmpdir_fresh, "crawl")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    pages = spark.createDataFrame([("https://a.com/", 200, "<title>A</title>")],
                                  "url string, http_status int, html string")
    _hits(hits_dir, "0.jsonl", ["https://a.com/", "https://b.com/", "https://a.com/"])
    q = crawl_hits_stream(spark, hits_dir, pages, target, ckpt, available_now=True)
    q.awaitTermination(120)
    _hits(hits_dir, "1.jsonl", ["https://b.com/", "https://c.com/"])
    q = crawl_hits_stream(spark, hits_dir, pages, target, ckpt, available_now=True)
    q.awaitTermination(120)
    rows = spark.read.parquet(target).collect()
    assert sorted(r.source_url for r in rows) == ["https://a.com/", "https://b.com/", "https://c.com/"]
    assert [r.extracted_name for r in rows if r.source_url == "https://a.com/"] == ["A"]


XML = """<Transfer>
<ABR><ABN>1</ABN><EntityName>Alpha Pty Ltd</EntityName></ABR>
<ABR><ABN>2</ABN><EntityName>Beta Holdings</EntityName></ABR>
<ABR><EntityTypeText>X</EntityTypeText></ABR>
</Transfer>"""


def test_run_all_twice_loads_once(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    with open(os.path.join(src, "abr.xml"), "w") as fh:
        fh.write(XML)
    _hits(os.path.join(src, "hits"), "h.jsonl", ["https://alpha.com/", "https://beta.com/x"])
    pages_path = os.path.join(src, "pages")
    spark.createDataFrame(
        [("https://alpha.com/", 200, "<title>Alpha | Home</title>"),
         ("https://beta.com/x", 200, "<title>Beta Holding</title>")],
        "url string, http_status int, html string").write.parquet(pages_path)
    out = os.path.join(tmpdir_fresh, "out")
    args = dict(registry_xml=os.path.join(src, "abr.xml"), index_hits=os.path.join(src, "hits"),
                pages=pages_path, out_dir=out)
    first = run_all(spark, **args)
    assert first["registry"] == 2 and first["crawl"] == 2
    assert (first["registry_inserted"], first["registry_quarantined"], first["crawl_inserted"],
            first["unified_written"]) == (2, 1, 2, 2)
    unified = {(r.abn, r.domain, r.match_type) for r in spark.read.parquet(os.path.join(out, "unified")).collect()}
    assert unified == {("1", "alpha.com", "EXACT"), ("2", "beta.com", "FUZZY_HIGH")}
    second = run_all(spark, **args)
    assert second["registry"] == 2 and second["crawl"] == 2
    assert (second["registry_inserted"], second["crawl_inserted"]) == (0, 0)
    assert (second["unified_written"], second["unified"]) == (0, 2)
    third = run_all(spark, cfg=MatchConfig(write_mode="append"), **args)
    assert third["unified"] == 4  # append, when asked for, adds the rows again
    assert len(os.listdir(os.path.join(out, "quarantine"))) >= 1


def test_registry_stream(spark, tmpdir_fresh):
    xml_dir = os.path.join(tmpdir_fresh, "xml")
    os.makedirs(xml_dir)
    target = os.path.join(tmpdir_fresh, "registry")
    quarantine = os.path.join(tmpdir_fresh, "quarantine")
    ckpt = os.path.join(tmpdir_fresh, "ckpt")
    with open(os.path.join(xml_dir, "a.xml"), "w") as fh:
        fh.write(XML)
    registry_xml_stream(spark, xml_dir, target, quarantine, ckpt, available_now=True).awaitTermination(120)
    with open(os.path.join(xml_dir, "b.xml"), "w") as fh:
        fh.write("<T><ABR><ABN>1</ABN><EntityName>Again</EntityName></ABR>"
                 "<ABR><ABN>3</ABN><EntityName>Gamma</EntityName></ABR></T>")
    registry_xml_stream(spark, xml_dir, target, quarantine, ckpt, available_now=True).awaitTermination(120)
    rows = sorted((r.abn, r.entity_name) for r in spark.read.parquet(target).collect())
    assert rows == [("1", "Alpha Pty Ltd"), ("2", "Beta Holdings"), ("3", "Gamma")]
    assert os.path.isdir(os.path.join(quarantine, "batch=0", "reason=missing_key_fields"))


def test_cli_commands(spark, tmpdir_fresh):
    from firmlink.cli import main

    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    with open(os.path.join(src, "abr.xml"), "w") as fh:
        fh.write(XML)
    _hits(os.path.join(src, "hits"), "h.jsonl", ["https://alpha.com/", "https://beta.com/x"])
    pages = os.path.join(src, "pages")
    spark.createDataFrame(
        [("https://alpha.com/", 200, "<title>Alpha | Home</title>"),
         ("https://beta.com/x", 200, "<title>Beta Holding</title>")],
        "url string, http_status int, html string").write.parquet(pages)
    out = os.path.join(tmpdir_fresh, "out")
    assert main(["stage-registry", "--xml", os.path.join(src, "abr.xml"), "--out", out], spark) == {"registry": 2}
    assert main(["stage-crawl", "--hits", os.path.join(src, "hits"), "--pages", pages, "--out", out],
                spark) == {"crawl": 2}
    assert main(["stage-crawl", "--hits", os.path.join(src, "hits"), "--pages", pages, "--out", out],
                spark) == {"crawl": 2}
    uni = os.path.join(out, "unified")
    args = ["unify", "--registry", os.path.join(out, "registry"), "--crawl", os.path.join(out, "crawl"),
            "--out", uni, "--mode", "insert_if_absent"]
    assert main(args, spark) == {"unified": 2}
    assert main(args, spark) == {"unified": 2}


def test_stream_replay_with_fresh_checkpoint_adds_nothing(spark, tmpdir_fresh):
    # losing the stream checkpoint replays every file: insert-if-absent keeps
    # the table exactly as it was
    hits_dir = os.path.join(tmpdir_fresh, "hits")
    target = os.path.join(tmpdir_fresh, "crawl")
    pages = spark.createDataFrame([("https://a.com/", 200, "<title>A</title>")],
                                  "url string, http_status int, html string")
    _hits(hits_dir, "0.jsonl", ["https://a.com/", "https://b.com/"])
    crawl_hits_stream(spark, hits_dir, pages, target, os.path.join(tmpdir_fresh, "ck1"),
                      available_now=True).awaitTermination(120)
    before = sorted(r.url_hash for r in spark.read.parquet(target).collect())
    crawl_hits_stream(spark, hits_dir, pages, target, os.path.join(tmpdir_fresh, "ck2"),
                      available_now=True).awaitTermination(120)
    after = sorted(r.url_hash for r in spark.read.parquet(target).collect())
    assert before == after and len(after) == 2


def test_run_all_overwrite_mode(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    with open(os.path.join(src, "abr.xml"), "w") as fh:
        fh.write(XML)
    _hits(os.path.join(src, "hits"), "h.jsonl", ["https://alpha.com/"])
    pages = os.path.join(src, "pages")
    spark.createDataFrame([("https://alpha.com/", 200, "<title>Alpha</title>")],
                          "url string, http_status int, html string").write.parquet(pages)
    args = dict(registry_xml=os.path.join(src, "abr.xml"), index_hits=os.path.join(src, "hits"),
                pages=pages, out_dir=os.path.join(tmpdir_fresh, "out"), cfg=MatchConfig(write_mode="overwrite"))
    assert run_all(spark, **args)["unified"] == 1
    assert run_all(spark, **args)["unified"] == 1


def test_unified_insert_of_null_numbers_is_idempotent(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    os.makedirs(src)
    with open(os.path.join(src, "abr.xml"), "w") as fh:
        fh.write("<T><ABR><EntityName>Alpha</EntityName></ABR><ABR><ABN>2</ABN><EntityName>Beta</EntityName></ABR></T>")
    _hits(os.path.join(src, "hits"), "h.jsonl", ["https://alpha.com/", "https://beta.com/"])
    pages = os.path.join(src, "pages")
    spark.createDataFrame([("https://alpha.com/", 200, "<title>Alpha</title>"), ("https://beta.com/", 200, "<title>Beta</title>")],
                          "url string, http_status int, html string").write.parquet(pages)
    args = dict(registry_xml=os.path.join(src, "abr.xml"), index_hits=os.path.join(src, "hits"), pages=pages,
                out_dir=os.path.join(tmpdir_fresh, "out"), cfg=MatchConfig(write_mode="insert_if_absent"))
    runs = [run_all(spark, **args) for _ in range(3)]
    assert [r["unified_written"] for r in runs] == [2, 0, 0]
    assert {r.abn for r in spark.read.parquet(os.path.join(args["out_dir"], "unified")).collect()} == {None, "2"}
