from topicgrove.llm.url_filters import judge

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.net", "/en/us/"), ("allow", "a.example.net", "/"),
         ("block", "com", ""), ("allow", "com", ""), ("allow", "", "/x"), ("block", None, "/"), ("block", "org", "/p")]


def brute(host, path):
    fits = [
        (len(h) + len(p), len(h), h + (p if p.startswith("/") else "/" + p), v)
        for v, h, p in [r for r in RULES if r != ("allow", "com", "")]
        if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, "allow")


def test_equals_brute_force(spark):
    hosts = ["net", "x.net", "example.net", "EXAMPLE.net", "b.a.example.net", "a.example.net", "notexample.net", "com", "q.com", "org", "netx", "a-b.net", "é.net"]
    paths = ["", "/", "/en", "/en/", "/en/us/1", "/en/usa", "/p", "/pq?x=/en/", "/x#/", "?a", "//"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "nothing", "http://", "a://b://c/d", "https:///x", "http://net/\n"]
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)] + [(None, urls[0], "", ""), (0, urls[0], "", "")], "page_id long, url string, host string, key string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    found = judge(pages, rules, slices=3).collect()
    assert len(found) == len(urls) + 2
    for r in found:
        url = urls[r.page_id] if r.page_id is not None else urls[0]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == brute(host, path), url


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert [r.verdict for r in judge(pages, none, default="block").collect()] == ["block"]
    assert judge(pages.where("false"), none).count() == 0


def test_very_long_hosts(spark):
    host = "a." * 60000 + "example.net"
    pages = spark.createDataFrame([(1, f"http://{host}/en/x"), (2, "http://x/y")], "page_id long, url string")
    rules = spark.createDataFrame([("block", "net", "/"), ("allow", "example.net", "/en/")], "verdict string, host string, path string")
    assert {r.page_id: (r.rule, r.verdict) for r in judge(pages, rules).collect()} == {1: ("example.net/en/", "allow"), 2: (None, "allow")}
