import datetime as dt
import hashlib

import pytest

from firmlink.functions.dates import norm_date, with_norm_date
from firmlink.functions.url import row_hash, url_domain, url_hash

# url -> network location, lower-cased
DOMAINS = {
    "https://Example.COM/a?b#c": "example.com",
    "http://user:pw@host.example.com:8080/x": "user:pw@host.example.com:8080",
    "//cdn.example.org/p": "cdn.example.org",
    "example.com/path": "",
    "localhost:8080//x": "",
    "mailto:a@b.c": "",
    "HTTP://A_B.com": "a_b.com",
    "http://[::1]:80/": "[::1]:80",
    "": "",
    "ftp://files.example.net": "files.example.net",
    "https://host?q=1": "host",
    "https://host#frag": "host",
    "  https://Lead.Space/x": "lead.space",
    "ht\ttp://tab.example.com/": "tab.example.com",
    "https://new\nline.com/": "newline.com",
    "\x01http://ctl.com/": "ctl.com",
    "http://[2001:db8::1]:8080/p": "[2001:db8::1]:8080",
    "http://[v1.fe]/": "[v1.fe]",
    "http://u@[::ffff:1.2.3.4]/": "u@[::ffff:1.2.3.4]",
    "http://[::1/x": None,
    "http://[abc]/": None,
    "http://a]b/": None,
    None: None,
}


def test_url_domain(spark):
    df = spark.createDataFrame([(u,) for u in DOMAINS], "u string")
    assert [r.d for r in df.select(url_domain("u").alias("d")).collect()] == list(DOMAINS.values())


def test_url_and_row_hash(spark):
    df = spark.createDataFrame([("https://a.b/ü", "x", None), ("", "y", "z")], "u string, a string, b string")
    rows = df.select(url_hash("u").alias("h"), row_hash("u", "a", "b").alias("r")).collect()
    assert rows[0].h == hashlib.sha256("https://a.b/ü".encode()).hexdigest()
    assert rows[1].h is None
    assert rows[0].r == hashlib.sha256("https://a.b/ü|x".encode()).hexdigest()
    assert rows[1].r == hashlib.sha256("|y|z".encode()).hexdigest()


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("2024-01-05", dt.date(2024, 1, 5)),
        (" 2024-01-05Z ", dt.date(2024, 1, 5)),
        ("2024-01-05T01:30:00+10:00", dt.date(2024, 1, 5)),
        ("2024-01-05 23:59:59.123", dt.date(2024, 1, 5)),
        ("20240105", dt.date(2024, 1, 5)),
        ("1/5/2024", dt.date(2024, 1, 5)),
        ("13/5/2024", dt.date(2024, 5, 13)),
        ("5 January 2024", dt.date(2024, 1, 5)),
        ("5 Jan 2024", dt.date(2024, 1, 5)),
        ("January 5, 2024", dt.date(2024, 1, 5)),
        ("2024-02-30", None),
        ("2024-01-05ZZ", None),
        ("junk", None),
        ("", None),
        ("   ", None),
        (None, None),
        ("2024-01-01 junk", None),
        ("2024/1/5", dt.date(2024, 1, 5)),
        ("01-05-2024", dt.date(2024, 1, 5)),
        ("13-05-2024", dt.date(2024, 5, 13)),
        ("1.5.2024", dt.date(2024, 1, 5)),
        ("5-Jan-2024", dt.date(2024, 1, 5)),
        ("Jan 5 2024", dt.date(2024, 1, 5)),
        ("September 30, 2023", dt.date(2023, 9, 30)),
        ("2024", None),
    ],
)
def test_norm_date(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(norm_date("s").alias("d")).first().d == expected
    assert with_norm_date(df, "s", "d").first().d == expected
