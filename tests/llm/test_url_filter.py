import re

from hypothesis import given, settings
from hypothesis import strategies as st

from dealscope.llm import url_filter as U

PARTS = ["http", "://", "example", ".", "org", "com", "net", "/", "es/", "en/1", "fr/", "de/",
         "?", "#", "a", "EN", ":80", "ads", "-", "track", "porn", "É"]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    rule = verdict = None
    for text, said in U.RULES.items():
        name, _, tail = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if rule is None or len(text) > len(rule):
                rule, verdict = text, said
    if rule is None:
        words = U.Vocabulary()
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in url) if host or path else ""

        def hit(term):
            return re.search(rf"(?<![^\W_]){term}(?![^\W_])", text)

        strict = [t for t in words.strict if hit(t)]
        soft = [t for t in words.soft if hit(t)]
        verdict = "block" if strict or len(soft) >= words.soft_limit else "allow"
    return host, path, rule, verdict


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_verdict_equals_brute_force(url):
    host, path = U.split_url(url)
    found = U.RuleIndex(U.RULES).find(host, path)
    counter = U.TermCounter(U.Vocabulary())
    hits = counter.hits(url if host or path else "")
    said = found or (None, "block" if counter.rejects(hits) else "allow")
    assert (host, path, *said) == brute(url)


def test_pages(spark):
    urls = [None, "", "nothing", "HTTP://WWW.Example.ORG/es/x?y", "http://a.org", "http://x.com/de/",
            "http://m.ads-track.example.net/en", "http://ads.example.net/", "http://leads.net/track",
            "http://a.net/PORN/", "http://a.net/" + "x/" * 50_000]
    rows = [(i, u, "clash") for i, u in enumerate([*urls, urls[3]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = {r["page_id"]: r for r in U.judge_urls(pages).collect()}
    assert len(out) == len(rows)
    for i, u, _ in rows:
        assert (out[i]["host"], out[i]["path"], out[i]["rule"], out[i]["verdict"]) == brute(u)
    assert [out[i]["verdict"] for i in (6, 7, 8, 9)] == ["block", "allow", "allow", "block"]
    assert U.judge_urls(pages.where("false")).count() == 0


def test_empty_vocabulary_and_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/porn")], "page_id long, url string")
    none = U.Vocabulary(strict=(), soft=())
    assert U.judge_urls(pages, rules={}, vocabulary=none).first()["verdict"] == "allow"


def test_vocabulary_decides_without_a_scheme(spark):
    urls = ["www.casino.example/xxx", "//host/porn", "ads track", "ads", "http://?porn", "leads", None]
    rows = [(i, u) for i, u in enumerate(urls)]
    out = U.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).orderBy("page_id").collect()
    assert [r["verdict"] for r in out] == ["block"] * 3 + ["allow", "block", "allow", "allow"]
    assert [(r["n_strict"], r["n_soft"]) for r in out[:4]] == [(2, 0), (1, 0), (0, 2), (0, 1)]
    assert all(r["host"] == r["path"] == "" and r["rule"] is None for r in out)
