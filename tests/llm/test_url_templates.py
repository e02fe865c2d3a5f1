import re

from pyspark.sql import functions as F

from signalwatch.llm import url_templates


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    best = None
    for text, says in url_templates.RULES:
        own, _, rest = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[0])):
            best = (text, says)
    return best or (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/1?x=/de/", "https://example.net/en/", "https://example.net/enx",
    "https://notexample.net/en/", "http://net/x", "http://x.net", "http://x.net?/en/", "http://x.net#top", "http://a.org/fr/9",
    "http://org/fr/", "http://org/fr", "http://b.example.com/de/1.html", "http://É.Example.com/de/", "a://b://c/d", "x\n://example.com/de/\n1",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(3, URLS[3]), (None, URLS[4])], "page_id long, url string")
    got = url_templates.judge(pages).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r.page_id is not None:
            host, path = parts(URLS[r.page_id])
            text, says = rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, text)
            assert r.verdict in ("block", "allow") and (says is None or r.verdict == says)
    assert url_templates.judge(pages.limit(0)).count() == 0


def tree(spark, rows):
    df = spark.createDataFrame(rows, "host string, path string, label int")
    paths, found = url_templates.build_templates(df)
    return {(r.host, r.path): r.template for r in paths.collect()}, {(r.host, r.template): r for r in found.collect()}


def test_variable_segments_become_wildcards(spark):
    rows = [("h", f"/user/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{chr(97 + i // 26)}/post{i}", None) for i in range(200)]
    rows += [("h", "/about", None)] * 30
    paths, found = tree(spark, rows)
    # both are without labels, so the branches are one
    assert paths[("h", "/user/aa/post0")] == "/{about|user}/*/post#" and paths[("h", "/about")] == "/{about|user}"
    assert sum(r.n for r in found.values()) == 230


def test_branches_merge_only_if_their_labels_agree(spark):
    rows = []
    for name, bad in (("spam", 95), ("junk", 93), ("news", 5), ("blog", 4)):
        rows += [("h", f"/{name}/{i}", int(i < bad)) for i in range(100)]
    rows += [("h", f"/unknown/{i}", None) for i in range(50)]
    paths, found = tree(spark, rows)
    assert paths[("h", "/spam/1")] == paths[("h", "/junk/1")] == "/{junk|spam}/#"
    assert paths[("h", "/news/1")] == paths[("h", "/blog/1")] == "/{blog|news}/#"
    assert paths[("h", "/unknown/1")] == "/unknown/#"
    verdicts = {t: r.rejected for (_, t), r in found.items()}
    assert verdicts == {"/{junk|spam}/#": True, "/{blog|news}/#": False, "/unknown/#": False}
    bad = found[("h", "/{junk|spam}/#")]
    prior = (95 + 93 + 5 + 4) / 400
    assert abs(bad.purity - (188 + 5 * prior) / 205) < 1e-9


def test_other_pages_of_a_rejected_template_are_blocked(spark):
    rows = [(i, f"http://bad.example.com/de/{i}") for i in range(40)] + [(100 + i, f"http://bad.example.com/en/{i}") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = url_templates.judge(pages).where(F.col("rule").isNull()).select("verdict").distinct().collect()
    assert [r.verdict for r in got] == ["allow"]


def test_paths_beyond_the_depth(spark):
    deep = "/" + "/".join("abcdefghij")
    paths, _ = tree(spark, [("h", deep, None), ("h", "", None), ("h", "/", None), ("", "", None)])
    assert paths[("h", deep)].endswith("/**") and len(paths) == 4


def test_unruled_pages_are_blocked_by_what_other_hosts_labels_say(spark):
    urls = [f"http://h{h}.example.com/de/{i}" for h in range(20) for i in range(5)]
    urls += [f"http://h{h}.example.net/en/{i}" for h in range(20) for i in range(5)]
    urls += [f"http://x.example.org/{s}/{i}" for s in ("de", "en", "es") for i in range(3)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_templates.judge(pages).where("rule IS NULL AND host = 'x.example.org'").collect()
    verdicts = {(r.template, r.verdict) for r in got}
    # "de" is bad on 20 hosts, "en" good on 20, of "es" nothing is known
    assert verdicts == {("/de/#", "block"), ("/en/#", "allow"), ("/es/#", "allow")}
    weight = 20 * 5 / (5 + 5)
    purity = {r.template: r.purity for r in got}
    assert abs(purity["/de/#"] - (weight + 5 * 0.5) / (weight + 5)) < 1e-9
    assert abs(purity["/en/#"] - 5 * 0.5 / (weight + 5)) < 1e-9 and purity["/es/#"] == 0.5


def test_unlabelled_branches_follow_the_branches_beside_them(spark):
    rows = [("h", f"/bad{c}x/{i}", 1) for c in "abcdefgh" for i in range(200)] + [("h", f"/new/{i}", None) for i in range(200)]
    rows += [("good", f"/ok{c}x/{i}", 0) for c in "abcdefgh" for i in range(200)] + [("good", f"/new/{i}", None) for i in range(200)]
    _, found = tree(spark, rows)
    verdicts = {k: r.rejected for k, r in found.items() if k[1] == "/new/#"}
    weight = 8 * 200 / 205
    assert verdicts == {("h", "/new/#"): True, ("good", "/new/#"): False}
    assert abs(found[("h", "/new/#")].purity - (weight + 2.5) / (weight + 5)) < 1e-6


def test_deep_branches_are_told_apart(spark):
    top = "/a/b/c/d/e/f"
    rows = [("h", f"{top}/{name}/{i}", bad) for name, bad in (("spam", 1), ("docs", 0), ("new", None)) for i in range(60)]
    rows += [("other", f"{top}/spam/{i}", None) for i in range(5)] + [("other", "/x" * 40, None)] * 2
    paths, found = tree(spark, rows)
    assert paths[("h", f"{top}/spam/1")] == f"{top}/spam/#" and paths[("h", f"{top}/docs/1")] == f"{top}/docs/**"
    verdicts = {t: r.rejected for (h, t), r in found.items() if h == "h"}
    assert verdicts == {f"{top}/spam/#": True, f"{top}/docs/**": False, f"{top}/new/**": False}
    # no labels below it anywhere
    assert paths[("other", "/x" * 40)].endswith("/**")
    assert sum(r.n for r in found.values()) == len(rows) and len(paths) == len(set(r[:2] for r in rows))
