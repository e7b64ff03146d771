"""SQL functions beside the column functions, the table function, and domains by rules."""

import pytest
from pyspark.sql import functions as F

from catamill.functions import dates as D
from catamill.functions import sql
from catamill.functions import urls as U
from catamill.operators import gates
from catamill.operators.suffixes import registered_domains


def test_sql_functions_are_the_column_functions(spark):
    sql.register(spark)
    rows = [
        ("https://www.A.org/x/?utm_source=1&b=2&a=%20z~*&_csrf_token=9#f", "July 6", "Swim lessons"), ("http://b.co.uk:8080/", "13/40 and 7/2", "Swim lessons camp"), ("  HTTPS://c.k12.ma.us/p//  ", "10/3", "Newsletter"), ("/rel?x=1", "summer 2026", "ESL program"),
        ("", "", ""), (None, None, None), ("https://1.2.3.4/x", "2026-07-06", "Now hiring"), ("https://d.e.f.com?q", "June - Oct", "Camp counselor-in-training"), ("https://com/careers/", "Sept 3", "x"), ("https://x.gov.uk/a?b&c=%zz", "40/1", "boot camp"), ("mailto:x", "May", "we're hiring"),
    ]
    df = spark.createDataFrame(rows, "url string, d string, name string")
    df.createOrReplaceTempView("sql_rows")
    got = spark.sql("SELECT host_of(url) h, registered_domain(host_of(url)) r, canonical_url(url) c, summer_window(d) s, gate_reason(name, url) g FROM sql_rows").collect()
    u = F.col("url")
    want = df.select(U.host_of(u).alias("h"), U.registered_domain(U.host_of(u)).alias("r"), U.canonical_url(u).alias("c"), D.starts_in_summer(F.col("d")).alias("s"), gates.noncamp_reason(F.col("name"), u, u, F.lit(""), F.lit(True)).alias("g")).collect()
    assert got == want and {r.g for r in got} >= {"lessons", "resource page", "school service", "job", None}


def test_page_links_in_a_lateral_join(spark):
    sql.register(spark)
    pages = [("https://a.org/p/q", '<a href="/x">A <b>b</b></a><a href="#y">n</a><A HREF=\'z?q\'>Z</A><a href="mailto:m">m</a><a href="http://[bad/">b</a>'), ("https://b.org/", None), (None, '<a href="https://c.org/1">one</a>')]
    spark.createDataFrame(pages, "base string, html string").createOrReplaceTempView("sql_pages")
    got = spark.sql("SELECT p.base, l.* FROM sql_pages p, LATERAL page_links(p.base, p.html) l").collect()
    assert [tuple(r) for r in got] == [("https://a.org/p/q", 0, "https://a.org/x", "A b"), ("https://a.org/p/q", 2, "https://a.org/p/z?q", "Z"), (None, 0, "https://c.org/1", "one")]


@pytest.mark.parametrize(
    ("host", "suffix", "domain"),
    [
        ("a.b.example.com", "com", "example.com"), ("com", "com", "com"), ("a.b.co.uk", "co.uk", "b.co.uk"), ("co.uk", "co.uk", "co.uk"), ("x.y.z.ck", "z.ck", "y.z.ck"), ("z.ck", "z.ck", "z.ck"), ("ck", "ck", "ck"), ("www.ck", "ck", "www.ck"),
        ("a.www.ck", "ck", "www.ck"), ("a.unknown", "unknown", "a.unknown"), ("10.0.0.1:80", "10.0.0.1", "10.0.0.1"), ("A.B.COM.:8080", "com", "b.com"), ("", "", ""), (None, "", ""), ("city.kobe.jp", "kobe.jp", "city.kobe.jp"), ("a.c.kobe.jp", "c.kobe.jp", "a.c.kobe.jp"),
    ],
)
def test_domains_by_rules(spark, host, suffix, domain):
    rules = spark.createDataFrame([(r,) for r in ("com", "uk", "co.uk", "*.ck", "!www.ck", "jp", "kobe.jp", "*.kobe.jp", "!city.kobe.jp", "", None)], "rule string")
    r = registered_domains(spark.createDataFrame([(host, 1), (host, 2)], "host string, k int"), rules).collect()
    assert [(x.suffix, x.domain) for x in r] == [(suffix, domain)] * 2
