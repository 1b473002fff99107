import numpy as np

from latewatch.llm import urlfilter
from latewatch.llm.queries import URL_RULES
from .support import rows

URLS = [None, "", "no scheme", "http://", "https://Example.COM/en/x?y", "https://www.example.com/en/", "https://a.www.example.com/en/z#t", "http://x.net/es/1", "http://x.net/fr", "http://net/fr/",
        "http://other.org/a", "http://com/", "http://example.com", "http://notexample.com/en/1", "ftp://é.net/es/é?q", "http://u:p@example.com:80/en/", "http://a.example.com?x://b/en/"]


def brute(url, rules=URL_RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len((h + p).encode()), len(h.encode()), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[2] if fit else None, max(fit)[3] if fit else "allow"


def test_shipped_and_joined_agree_with_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, html string, rule string")
    rules = spark.createDataFrame([*URL_RULES, (None, "/", "block")], "host string, path string, verdict string")
    for limit in (1 << 20, 1):
        got = rows(urlfilter.judge(pages, rules, limit))
        assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == dict(enumerate(map(brute, URLS)))
        assert len(got) == len(URLS)
    assert urlfilter.judge(pages.where("false"), rules).count() == 0
    assert {r["verdict"] for r in rows(urlfilter.judge(pages, rules.where("false")))} == {"allow"}


def test_equal_keys_are_confirmed_on_the_string():
    array = urlfilter.DigestArray(urlfilter.DigestArray.pack([(b"a.com/", True), (b"b.com/", False), (b"c.com/x", True), (b"a.com/", False)]))
    assert [array.rule(i) for i in array.probe([b"a.com/", b"b.com/", b"zzz"]).tolist()[:2]] == [b"a.com/", b"b.com/"]
    forced = np.full(2, array.keys[1], np.uint64)  # another string under a stored key is not a hit
    assert array.probe([b"zzz", array.rule(1)], forced).tolist() == [-1, 1]
    assert len(array.keys) == 3


def test_both_ways_agree_on_odd_rules_and_random_urls(spark):
    rng = np.random.default_rng(3)
    hosts = ["münchen.de", "de", "bad.com", "com", "日本.jp", "a.b.com", "ünï.com", "", "."]
    paths = ["", "/", "/x", "/x/y", "/é", "/é/ü", "/日本", "/日"]
    odd = [("münchen.de", "/x", "block"), ("bad.com", "", "block"), ("com", "x", "block"), ("co/m", "/x", "block"), ("b.com", "/é", "allow"),
           ("de", "", "allow"), ("日本.jp", "/日本", "block"), ("jp", "/日", "allow"), ("münchen.de", "/x", "allow"), ("ünï.com", "/é/ü", None), (None, "/", "block"), ("com", None, "block")]
    more = [(hosts[h], paths[p], ["allow", "block"][v]) for h, p, v in zip(rng.integers(0, 7, 12), rng.integers(0, len(paths), 12), rng.integers(0, 2, 12))]
    fixed = ["https://münchen.de/x", "https://bad.com/z", "https://www.bad.com", "http://日本.jp/日本/語", "http://a.日本.jp/日曜", "http://x.de", None]
    urls = [f"s://{rng.choice(['', 'w.', 'é.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '/q', 'é', '?a/b', '#c'])}" for _ in range(400)] + fixed * 3
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for listed in (odd, odd + more):
        verdicts = {}  # of repeated rules the blocking one holds
        for h, p, v in listed:
            if h is not None and p is not None and "/" not in h and (p == "" or p[0] == "/"):
                verdicts[h, p] = "block" if v == "block" else verdicts.get((h, p), "allow")
        want = {i: brute(u, [(h, p, v) for (h, p), v in verdicts.items()]) for i, u in enumerate(urls)}
        given = spark.createDataFrame(listed, "host string, path string, verdict string")
        for limit in (1 << 20, 1):
            got = rows(urlfilter.judge(pages, given, limit))
            assert len(got) == len(urls) and {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == want
    assert {want[urls.index(u)][3] for u in fixed[:3]} == {"block"}
