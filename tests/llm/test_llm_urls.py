import datetime as dt

from llm_fixtures import as_rows
from tidemark.llm.url_filter import host_of, intervals, judge


def day(text):
    return dt.date.fromisoformat(text)


ENTRIES = [
    ("example.com", "2020-01-10", "block"), ("example.com", "2020-03-05", "allow"), ("example.com", "2020-03-05", "block"),
    ("example.com", "2021-06-01", "allow"), ("a.example.com", "2020-02-01", "allow"), ("org", "2020-01-01", "block"), (None, "2020-01-01", "block"),
]
CAPTURES = [
    (1, "https://A.example.com/x?y#z", "2020-01-09"), (2, "https://a.example.com", "2020-01-10"), (3, "http://a.example.com./", "2020-02-01"),
    (4, "http://u:p@b.example.com:8080/", "2020-03-04"), (5, "http://b.example.com", "2022-01-01"), (6, "http://notexample.com", "2020-06-01"),
    (7, None, "2020-06-01"), (8, "", "2020-06-01"), (9, "http://x.org", None), (9, "http://x.org", "2020-01-01"), (9, "http://x.org", "2020-01-01"),
]


def frames(spark, captures=CAPTURES, entries=ENTRIES):
    c = spark.createDataFrame([(p, u, d and day(d)) for p, u, d in captures], "page_id BIGINT, url STRING, fetched DATE")
    e = spark.createDataFrame([(s, day(d), a) for s, d, a in entries], "suffix STRING, day DATE, action STRING")
    return c, e


def test_verdict_is_that_of_the_entry_active_at_fetch(spark):
    got = as_rows(judge(*frames(spark)), "page_id", "suffix", "verdict")
    assert got == sorted(
        [
            (1, None, "unlisted"), (2, "example.com", "block"), (3, "a.example.com", "allow"), (4, "example.com", "block"),
            (5, "example.com", "allow"), (6, None, "unlisted"), (7, None, "unlisted"), (8, None, "unlisted"),
            (9, None, "unlisted"), (9, "org", "block"), (9, "org", "block"),
        ], key=repr)


def test_entries_become_intervals_without_overlap(spark):
    _, entries = frames(spark)
    got = as_rows(intervals(entries).where("suffix = 'example.com'"), "valid_from", "valid_to", "action")
    assert [(str(a), str(b), c) for a, b, c in got] == [
        ("2020-01-10", "2020-03-05", "block"), ("2020-03-05", "2021-06-01", "block"), ("2021-06-01", "9999-12-31", "allow"),
    ]


def test_empty_sides(spark):
    captures, entries = frames(spark)
    assert judge(captures.limit(0), entries).count() == 0
    assert {r["verdict"] for r in judge(captures, entries.limit(0)).collect()} == {"unlisted"}


def test_hosts(spark):
    urls = ["HTTPS://User@Host.Example:443/p", "host.example/p", "//x", "mailto:a@b", "https:///p"]
    df = spark.createDataFrame([(u,) for u in urls], "u STRING")
    assert [r[0] for r in df.select(host_of(df.u)).collect()][:2] == ["host.example", "host.example"]


def test_long_hosts_and_stray_signs(spark):
    """A blocked parent counts however many labels stand before it, and signs around a host do not hide it."""
    deep = "http://" + "x." * 130 + "example.com/"
    odd = [" http://bad.com", "bad.com..", "http://bad.com:80:80/", "http://u@bad.com.:80", "\thttps://BAD.com", deep]
    captures, entries = frames(spark, [(k, u, "2020-06-01") for k, u in enumerate(odd)], [("bad.com", "2020-01-01", "block"), ("example.com", "2020-01-01", "block")])
    assert [r["verdict"] for r in judge(captures, entries).orderBy("page_id").collect()] == ["block"] * len(odd)
    assert {r["verdict"] for r in judge(captures, entries.limit(0)).collect()} == {"unlisted"}
