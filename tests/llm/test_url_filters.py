from corpusloom.llm.url_filters import url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es", "block")]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_against_brute_force(spark):
    urls = [None, "", "nourl", "http://example.com", "http://EXAMPLE.com/en/x?y=/z", "https://a.www.example.com/en/", "ftp://x.net/essay#f",
            "http://notexample.com/en/", "http://é.COM/a", "http://a.com?x/en/", "://net/es", "http://x.com/a://b", "http://" + "a." * 3000 + "com/" + "q" * 50000]
    urls += ["http://example.com/en/x"] * 3
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter(df, rules).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}


def test_no_rules_and_no_rows(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter(df, none, "block").collect()] == [(1, "a.com", "/", None, "block")]
    assert url_filter(df.limit(0), none).count() == 0
