import datetime as dt

from gridtide.llm import urls

DAY = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def brute(url, at, entries):
    import re

    m = re.match(urls.HOST, url or "")
    host = m[1].lower() if m and m[1] else None
    if host is None or at is None:
        return host, 0, None
    path = re.match(urls.PATH, url)
    parts = [p for p in (path[1] if path else "").split("/") if p]
    held = {}
    for kind, pattern, category, action, day in entries:
        if None not in (kind, pattern, category, day) and action in ("add", "remove") and day <= at:
            held.setdefault((kind, pattern, category), []).append((day, action == "remove", action))
    hits = []
    for (kind, pattern, category), changes in held.items():
        day, removed, _ = max(changes)
        fits = {"host": host == pattern, "domain": host == pattern or host.endswith("." + pattern), "prefix": any(f"{host}/{'/'.join(parts[:k])}" == pattern for k in range(1, len(parts) + 1))}[kind]
        if fits and not removed:
            hits.append((-len(pattern), category, kind, pattern, day))
    return host, len(hits), min(hits)[1:] if hits else None


def test_against_brute_force(spark):
    entries = [
        ("domain", "bad.org", "spam", "add", DAY(10)), ("domain", "bad.org", "spam", "remove", DAY(20)), ("domain", "bad.org", "spam", "add", DAY(30)), ("domain", "bad.org", "spam", "add", DAY(35)),
        ("host", "www.bad.org", "adult", "add", DAY(0)), ("host", "www.bad.org", "adult", "remove", DAY(0)), ("host", "x.net", "spam", "add", DAY(5)), ("host", "x.net", "spam", "add", DAY(5)),
        ("prefix", "x.net/a/b", "malware", "add", DAY(7)), ("prefix", "x.net/a", "adult", "add", DAY(9)), ("host", None, "spam", "add", DAY(1)), ("host", "x.net", "other", "drop", DAY(1)),
    ]
    pages = ["http://www.bad.org/x", "HTTP://BAD.org", "http://notbad.org/", "https://u:p@x.net:8080/a/b/c?q=1", "http://x.net/a/bc", "http://x.net//a//b", "nonsense", "", None, "http:///p", "http://a.b.www.bad.org/#x"]
    captures = [(i, u, None if d < 0 else DAY(d)) for i, u in enumerate(pages) for d in (-1, 0, 5, 9, 10, 19, 20, 29, 30, 35, 99)] * 2
    df = spark.createDataFrame(captures, "page_id long, url string, fetched date").selectExpr("*", "1 AS n", "2 AS top", "'z' AS kind")
    table = spark.createDataFrame(entries, "kind string, pattern string, category string, action string, listed_at date")
    rows = urls.judge(df, table).collect()
    assert len(rows) == len(captures)
    for r in rows:
        top = (r.category, r.kind, r.pattern, r.active_since) if r.blocked else None
        assert (r.host, r.n_active, top) == brute(r.url, r.fetched, entries), r


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", DAY(1))], "page_id long, url string, fetched date")
    none = spark.createDataFrame([], "kind string, pattern string, category string, action string, listed_at date")
    row = urls.judge(pages, none).first()
    assert not row.blocked and row.n_active == 0
    assert urls.judge(pages.limit(0), none).count() == 0


def test_very_long_urls(spark):
    deep = "http://a.bad.org/" + "/".join(f"p{i}" for i in range(3000)) + "?" + "q" * 50_000
    wide = "http://" + ".".join(f"s{i}" for i in range(300)) + ".bad.org/x"
    pages = spark.createDataFrame([(1, deep, DAY(5)), (2, wide, DAY(5)), (3, "http://good.org/" + "x" * 100_000, DAY(5))], "page_id long, url string, fetched date")
    table = spark.createDataFrame([("domain", "bad.org", "spam", "add", DAY(1)), ("prefix", "a.bad.org/p0/p1", "malware", "add", DAY(2))], "kind string, pattern string, category string, action string, listed_at date")
    got = {r.page_id: (r.blocked, r.n_active, r.pattern) for r in urls.judge(pages, table).collect()}
    assert got == {1: (True, 2, "a.bad.org/p0/p1"), 2: (True, 1, "bad.org"), 3: (False, 0, None)}
