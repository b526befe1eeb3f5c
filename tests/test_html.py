"""Company fields from HTML: microdata, meta fallbacks, title, industry,
status gate and size cap."""

import pytest

from firmlink.functions.html import (
    MAX_STORED_HTML_CHARS,
    extract_company_fields,
)

PAGE = "<html><head><title>{t}</title></head><body>{b}</body></html>"

CASES = [
    # (html, expected name, expected industry)
    (PAGE.format(t="Acme | Home", b=""), "Acme", None),
    (PAGE.format(t="  Tom &amp; Jerry&quot;s  ", b=""), 'Tom & Jerry"s', None),
    ('<meta property="og:site_name" content="Site 1">' + PAGE.format(t="T", b=""), "Site 1", None),
    ('<meta property="og:site_name" content=""><meta property="og:title" content="X">'
     + PAGE.format(t="Title", b=""), "Title", None),
    ('<meta property="og:title" content=" OG ">' + PAGE.format(t="Title", b=""), "OG", None),
    ('<meta content="Rev" property=\'og:site_name\'>' + PAGE.format(t="Title", b=""), "Rev", None),
    ('<meta property="og:site_name" content="   ">' + PAGE.format(t="Title", b=""), "Title", None),
    ('<meta property="og:site_name" content="   "><p>no title</p>', "", None),
    ('<div itemtype="https://schema.org/Organization"><span itemprop="name"> Org <b>X</b> </span></div>'
     + PAGE.format(t="T", b=""), "OrgX", None),
    ('<DIV ITEMTYPE="http://SCHEMA.ORG/organization"><h1 itemprop=name>Big Co</h1></DIV>', "Big Co", None),
    ('<div itemtype="https://schema.org/Organization"><span itemprop="name">  </span></div>'
     + PAGE.format(t="Fallback", b=""), "Fallback", None),
    ('<span itemprop="name">Before</span><div itemtype="https://schema.org/Organization">'
     '<i itemprop="name">After</i></div>', "After", None),
    ('<div itemtype="https://schema.org/Person"><span itemprop="name">P</span></div>'
     + PAGE.format(t="T", b=""), "T", None),
    ('<meta name="keywords" content=" mining, gold"><meta name="industry" content="Retail">'
     + PAGE.format(t="T", b=""), "T", "mining"),
    ('<meta name="keywords" content=", gold"><meta name="industry" content=" Retail ">', None, "Retail"),
    ('<meta name="keywords" content=" , gold">', None, ""),
    ('<meta name="Keywords" content="x"><meta name="industry" content="Retail">', None, "Retail"),
    ("<!-- <title>Hidden</title> --><script>var s='<title>No</title>'</script><title>Real</title>",
     "Real", None),
    ("<title></title>", None, None),
    ("<title>Smith &#038; Sons &#8211; Home &#x27;s &#X41;&#0;</title>", "Smith & Sons \u2013 Home 's A\ufffd", None),
    ("<title>&#128512; Emoji &amp;#39;</title>", "\U0001F600 Emoji &#39;", None),
    ("<title>Caf&eacute; &ndash; Bistro&trade;</title>", "Caf\u00e9 \u2013 Bistro\u2122", None),
    ("<title>&euro;5 Se&ntilde;or &notanentity; &amp;euro; &NotEqualTilde; &hearts;</title>",
     "\u20ac5 Se\u00f1or &notanentity; &euro; \u2242\u0338 \u2665", None),
    ('<div itemtype="https://schema.org/Organization"><span itemprop="name brand">Brand</span>'
     '<b itemprop="name">Exact</b></div>', "Exact", None),
    ('<meta property="og:site_name x" content="No"><meta property=og:title content=Yes>'
     + PAGE.format(t="T", b=""), "Yes", None),
    ('<meta property="OG:SITE_NAME" content="Upper">' + PAGE.format(t="T", b=""), "T", None),
]


@pytest.mark.parametrize("html,name,industry", CASES)
def test_fields(spark, html, name, industry):
    df = spark.createDataFrame([(html, 200)], "html string, http_status int")
    staged = extract_company_fields(df).first()
    assert (staged.extracted_name, staged.extracted_industry) == (name, industry)


def test_status_gate_and_size_cap(spark):
    big = "<title>Big</title>" + "x" * MAX_STORED_HTML_CHARS
    rows = [(PAGE.format(t="A", b=""), 200), (PAGE.format(t="B", b=""), 404), (None, None),
            ("", 200), (big, 200), (big[: MAX_STORED_HTML_CHARS - 1], 200)]
    df = spark.createDataFrame(rows, "html string, http_status int")
    out = extract_company_fields(df, max_stored_chars=MAX_STORED_HTML_CHARS).collect()
    assert [r.extracted_name for r in out] == ["A", None, None, None, "Big", "Big"]
    assert [r.raw_html is not None for r in out] == [True, False, False, False, False, True]
    whole = extract_company_fields(df).collect()
    assert [r.raw_html for r in whole] == [rows[0][0], None, None, None, big, rows[5][0]]
