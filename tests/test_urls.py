import random
from urllib.parse import urljoin, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from spinneret.functions import urls

CANONICAL = [
    ("http://a.cn", "http://a.cn/"),
    ("http://a.cn/x.shtml?spm=1#z", "http://a.cn/x.shtml"),
    ("http://a.cn/x.HTML?b=1", "http://a.cn/x.HTML?b=1"),
    ("http://a.cn/q?x=1.html?y", "http://a.cn/q"),
    ("https://a.cn/p.PDF?x=1", ""),
    ("http://a.cn/x.pdf;v=1?q=2", ""),
    ("http://a.cn/pdf", "http://a.cn/pdf"),
    ("http://a.cn/i?utm_source=a&k=1&flag&e=&spmX=2#f", "http://a.cn/i?k=1&e="),
    ("ftp://a", ""),
    ("HTTP://a.cn/", ""),
    ("httpS://a.cn/b", "https://a.cn/b"),
    ("httpx:/a;b", "httpx:/a;b"),
    ("http://a.cn/a;", "http://a.cn/a"),
    ("http://u:p@a.cn:80/a;b;c/d;e?x=1", "http://u:p@a.cn:80/a;b;c/d;e?x=1"),
    ("http://a.cn/x\t.gif\n", ""),
    ("http:pdf", ""),
    ("http:a", "http:a"),
    ("http://a.cn?x=1", "http://a.cn/?x=1"),
    ("http://a.cn/a.b/c", "http://a.cn/a.b/c"),
    ("http://a.cn/?=v&a==b", "http://a.cn/?=v&a==b"),
    ("", ""),
    (None, None),
]


def applied(spark, rows, names, function):
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(rows)],
        "i int, " + ", ".join(f"{n} string" for n in names),
    )
    out = function(*[F.col(n) for n in names]).alias("out")
    return [r["out"] for r in df.select("i", out).orderBy("i").collect()]


def test_canonical_table(spark):
    out = applied(spark, [(u,) for u, _ in CANONICAL], ["u"], urls.canonical_url)
    assert out == [expected for _, expected in CANONICAL]


ALPHABET = [
    "a", "b.c", "/", "/", "..", ".", "?", "#", ";", "&", "=", ":", "//", "http:", "https://h.cn",
    "%20", "é", ".pdf", ".ZIP", "spm", "utm_x", ".html", " ", "\n",
]


def random_text(rng, most):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most)))


def spelled_by_rules(url):
    """The canonical rules, spelled with the standard library."""
    if not url.startswith("http"):
        return ""
    if any(marker in url for marker in urls.STATIC_PAGE_MARKERS):
        return url.split("?")[0]
    parts = urlparse(url)
    path = parts.path or "/"
    if path.split(".")[-1].lower() in urls.BINARY_SUFFIXES:
        return ""
    query = "&".join(
        q for q in parts.query.split("&")
        if "=" in q and not q.startswith(urls.TRACKING_KEY_PREFIXES)
    )
    return urlunparse((parts.scheme, parts.netloc, path, parts.params, query, ""))


def test_canonical_random(spark):
    rng = random.Random(1)
    cases = [rng.choice(["http://h.cn", "https://", "http:", "httpX:", "http", "HTTPS://h.cn"])
             + random_text(rng, 9) for _ in range(1500)]
    cases = [c for c in cases if parsable(c, any_scheme=True)]
    out = applied(spark, [(c,) for c in cases], ["u"], urls.canonical_url)
    for case, got in zip(cases, out):
        assert got == spelled_by_rules(case), case


def test_single_rules_random(spark):
    rng = random.Random(5)
    cases = ["http://h.cn" + random_text(rng, 9) for _ in range(600)]
    rows = [(c,) for c in cases]
    for case, got in zip(cases, applied(spark, rows, ["u"], urls.drop_fragment)):
        assert got == urlunparse(urlparse(case)._replace(fragment="")), case
    for case, got in zip(cases, applied(spark, rows, ["u"], urls.drop_binary)):
        binary = urlparse(case).path.split(".")[-1].lower() in urls.BINARY_SUFFIXES
        assert got == ("" if binary else case), case
    for case, got in zip(cases, applied(spark, rows, ["u"], urls.strip_tracking)):
        parts = urlparse(case)
        kept = [q for q in parts.query.split("&")
                if "=" in q and not q.startswith(urls.TRACKING_KEY_PREFIXES)]
        assert got == urlunparse(parts._replace(query="&".join(kept))), case


def parsable(url, any_scheme=False):
    try:
        scheme = urlparse(url).scheme
    except ValueError:
        return False
    return any_scheme or scheme in ("", "http", "https")


RESOLVED = [
    ("http://a.cn/b/c/d;p?q", "g"),
    ("http://a.cn/b/c/d;p?q", "./g/"),
    ("http://a.cn/b/c/d;p?q", "/g"),
    ("http://a.cn/b/c/d;p?q", "//g"),
    ("http://a.cn/b/c/d;p?q", "?y"),
    ("http://a.cn/b/c/d;p?q", "#s"),
    ("http://a.cn/b/c/d;p?q", ";x"),
    ("http://a.cn/b/c/d;p?q", "../.."),
    ("http://a.cn/b/c/d;p?q", "../../../../g"),
    ("http://a.cn/b/c/d;p?q", "/./g/../h/."),
    ("http://a.cn/b/c/d;p?q", "https://z.cn/a/../b"),
    ("http://a.cn/b/c/d;p?q", "http://z.cn/a/../b;#"),
    ("http://a.cn/b/c/d;p?q", "mailto:x@y"),
    ("http://a.cn/b/c/d;p?q", "javascript:void(0)"),
    ("http://a.cn/b/c/d;p?q", "http:g"),
    ("http://a.cn", "g"),
    ("http://a.cn", ""),
    ("http://a.cn/x//y/", "z//w"),
    ("", "g"),
    ("http://a.cn/é/", "ü?x=ä"),
    ("http://a.cn/b//", "c//"),
]


def test_resolve_table(spark):
    out = applied(spark, RESOLVED, ["b", "l"], urls.resolve_link)
    for (base, link), got in zip(RESOLVED, out):
        assert got == urljoin(base, link), (base, link)


def test_resolve_random(spark):
    rng = random.Random(2)
    paths = ["", "?q", "#f"] + ["/" + random_text(rng, 6) for _ in range(40)]
    cases = [("http://h.cn" + rng.choice(paths), random_text(rng, 8)) for _ in range(1500)]
    cases = [c for c in cases if parsable(c[0]) and parsable(c[1])]
    out = applied(spark, cases, ["b", "l"], urls.resolve_link)
    for (base, link), got in zip(cases, out):
        assert got == urljoin(base, link), (base, link)


@pytest.mark.parametrize(
    "column,expected",
    [
        (urls.netloc, "u@a.example.com:8080"),
        (urls.site_key, "u@a.example.com:8080"),
        (urls.base_name, "c.jpg?x=1#f"),
        (urls.origin_cut, "http://u@a.example.com"),
        (urls.drop_fragment, "http://u@a.example.com:8080/b/c.jpg?x=1"),
        (urls.drop_binary, ""),
        (urls.strip_tracking, "http://u@a.example.com:8080/b/c.jpg?x=1#f"),
    ],
)
def test_single_columns(spark, column, expected):
    out = applied(spark, [("http://u@a.example.com:8080/b/c.jpg?x=1#f",)], ["u"], column)
    assert out == [expected]


def test_host_validity_and_nulls(spark):
    rows = [("http://a.cn/x",), ("http://localhost/x",), ("/x.y",), (None,)]
    assert applied(spark, rows, ["u"], urls.valid_host) == [True, False, False, None]
    pairs = [(None, "a"), ("http://a.cn/", None)]
    assert applied(spark, pairs, ["b", "l"], urls.resolve_link) == [None, None]


def test_very_long_links(spark):
    long = "/a" * 30000
    cases = [("http://h.cn/", long), ("http://h.cn/", long[1:] + "?x=1"), ("http://h.cn/", long + ";p#f")]
    out = applied(spark, cases, ["b", "l"], urls.resolve_link)
    assert out == [urljoin(base, link) for base, link in cases]
    rows = [(o,) for o in out]
    assert applied(spark, rows, ["u"], urls.canonical_url) == [spelled_by_rules(o) for o in out]
