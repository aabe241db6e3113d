import re

from millrace.llm import url_filter as op


def pages(spark, urls):
    rows = [u if isinstance(u, tuple) else (i, u) for i, u in enumerate(urls)]
    return spark.createDataFrame([(i, u, "h", "x", 1.0) for i, u in rows], "page_id bigint, url string, host string, rule string, purity double")


def brute(url):
    _, found, rest = (url or "").partition("://")
    rest = rest if found else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in op.RULES:
        domain, _, tail = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Net", "http://a.net/", "http://a.net?x=/en/", "http://example.net/en/1",
    "http://sub.example.net/en/1#f", "http://badexample.net/en/1", "http://notnet/", "http://net/x", "http://example.com/de/",
    "http://x.example.com/de", "http://x.org/fr/a?b#c", "http://x.org/FR/a", "http://É.org/fr/ü", "http://a.com/" + "s/" * 500,
    "http://a.com/1", "http://a.com/1", "http://a.b://c/d", "http://a.com/\n/x",
]


def test_parts_and_rules_match_brute_force(spark):
    rows = [*enumerate(URLS), (3, URLS[3]), (None, "http://a.net/")]
    got = op.filter_urls(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted(((i, *brute(u)[:3]) for i, u in rows), key=repr)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=repr) == want
    by_id = {r.page_id: r for r in got}
    for i, u in rows:
        assert by_id[i].verdict in ("allow", "block")
        if brute(u)[3]:
            assert by_id[i].verdict == brute(u)[3]


def test_templates_learn_from_labelled_pages(spark):
    rows = [("h.test", f"/shop/{i}", "block" if i < 40 else None) for i in range(60)]
    rows += [("h.test", f"/news/{i}", "allow" if i < 30 else None) for i in range(60)]
    rows += [("h.test", f"/blog/{i}", "allow" if i < 30 else None) for i in range(60)]
    rows += [("h.test", f"/rare{i}/x", None) for i in range(5)] + [("other.test", "/shop/1", None)]
    table = spark.createDataFrame(rows, "host string, path string, verdict string")
    got = {(r.host, r.path): r for r in op.path_templates(table).collect()}
    assert got["h.test", "/shop/55"].template == "/shop/*" and got["h.test", "/shop/55"].purity > op.REJECT
    assert got["h.test", "/news/55"].template == "/blog|news/*"  # no different share of blocked pages: one branch
    assert got["h.test", "/news/55"].purity < 0.1
    assert got["h.test", "/rare1/x"].template.startswith("/*/")
    assert got["other.test", "/shop/1"].purity < op.REJECT  # evidence stays with its host


def test_named_children_are_few(spark):
    rows = [("a.test", f"/{i % 200}/x", None) for i in range(4000)]
    table = spark.createDataFrame(rows, "host string, path string, verdict string")
    assert {r.template for r in op.path_templates(table).collect()} == {"/*/x"}


def test_empty_table(spark):
    assert op.filter_urls(pages(spark, ["x"]).limit(0)).count() == 0
