"""Crawl staging from JSON-lines hit files and fetched pages."""

import json
import os

from firmlink.plans.stage_crawl import stage_crawl
from firmlink.schemas import CRAWL_FIELDS
from firmlink.sources.index_hits import read_index_hits

ORD = ["_file", "_block", "_row"]


def _files(tmp):
    hits = os.path.join(tmp, "hits")
    os.makedirs(hits)
    lines = [
        json.dumps({"url": "https://a.example.com/x", "status": "200"}),
        "",
        "{bad json",
        json.dumps({"original": "https://b.example.com/", "mime": "text/html"}),
        json.dumps({"url": "", "original": ""}),
        json.dumps(["https://c.example.com/"]),
        json.dumps({"url": "https://a.example.com/x", "status": "301"}),
        json.dumps({"url": "https://nofetch.example.com/"}),
    ]
    with open(os.path.join(hits, "part-0.jsonl"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return hits


def test_stage_crawl_from_files(spark, tmpdir_fresh):
    hits = read_index_hits(spark, _files(tmpdir_fresh))
    pages = spark.createDataFrame(
        [("https://a.example.com/x", 200, "<title>Alpha | home</title>"),
         ("https://b.example.com/", 404, "<title>Gone</title>")],
        "url string, http_status int, html string",
    )
    rows = {r.source_url: r for r in stage_crawl(hits, pages, ORD).collect()}
    assert set(rows) == {"https://a.example.com/x", "https://b.example.com/", "https://nofetch.example.com/"}
    a = rows["https://a.example.com/x"]
    assert (a.domain, a.extracted_name, a.http_status) == ("a.example.com", "Alpha", 200)
    assert json.loads(a.extra) == {"cc_index": {"url": "https://a.example.com/x", "status": "200"}}
    b = rows["https://b.example.com/"]
    assert (b.extracted_name, b.http_status, b.raw_html) == (None, 404, None)
    assert rows["https://nofetch.example.com/"].http_status is None
    assert all(r.inserted_at is not None for r in rows.values())

    # second load of the same files inserts nothing
    target = spark.createDataFrame([tuple(getattr(r, c) for c in CRAWL_FIELDS) for r in rows.values()],
                                   ", ".join(f"{c} {'int' if c == 'http_status' else 'string'}" for c in CRAWL_FIELDS))
    again = stage_crawl(read_index_hits(spark, os.path.join(tmpdir_fresh, "hits")), pages, ORD, target=target)
    assert again.count() == 0
