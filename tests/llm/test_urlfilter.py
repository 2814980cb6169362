from __future__ import annotations

import random
import re

from tallyhouse.llm import urlfilter
from tallyhouse.llm.queries import op10_url_filters
from tests.llm.helpers import SMALL, by, whole, with_clashes

PAGES = "page_id bigint, url string, html string"


def pattern(glob):
    parts = re.split(r"(\*\*|\*)", glob)
    return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts))


def decide(url):
    """Verdict and rule by string comparisons, and regular expressions for the globs."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        (len(h) + len(p), h + p, verdict)
        for verdict, h, p in urlfilter.SITE_RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    spam = any(pattern(g).fullmatch(f".{host}{path}") for g in urlfilter.BLOCKED_GLOBS)
    return host, path, None, "block" if spam else "allow"


def test_query_equals_comparisons(spark):
    found = by(op10_url_filters(spark, SMALL).collect(), "page_id")
    for row in whole("pages"):
        got = found[row["page_id"]]
        assert (got["host"], got["path"], got["rule"], got["verdict"]) == decide(row["url"])


def test_odd_urls(spark):
    urls = [None, "", "net/", "://", "http://net", "http://net/", "HTTP://A.NET/x", "http://xnet/", "http://x.org/fr/", "http://x.org/a.net/b", "http://x.org/fr"]
    urls += ["http://example.net/en/?q", "http://example.net/en", "http://a.example.com/de/#", "http://example.com?/de/", "http://É.net/é", "a://b://c.net/", "http://free-bets.org/"]
    urls += ["http://my.casino.org/x", "http://x.org/casino/", "http://x.org/" + "a" * 50_000 + "download-free", "http://x.org/a.exe", "http://x.org/a.exe/b", "http://u:p@net:80/", "http://x\n.net/\n"]
    df = with_clashes(spark.createDataFrame([(k, url, None) for k, url in enumerate(urls)] + [(0, None, None), (None, "http://net/", "x")], PAGES), "host", "rule", "glob")
    rows = urlfilter.judge(df).collect()
    assert len(rows) == len(urls) + 2
    for row in rows:
        url = "http://net/" if row.page_id is None else urls[row.page_id]
        assert (row.host, row.path, row.rule, row.verdict) == decide(url), url
    assert urlfilter.judge(df.limit(0)).collect() == []


def test_automaton_equals_regular_expressions():
    draw = random.Random(2)
    for _ in range(60):
        globs = ["".join(draw.choice(["a", "b", "/", "*", "**", "é"]) for _ in range(draw.randrange(1, 30))).replace("***", "**") for _ in range(12)]
        globs = [g.replace("***", "**").replace("***", "**") for g in globs]
        texts = ["".join(draw.choice("ab/é") for _ in range(draw.randrange(14))) for _ in range(40)]
        fits = urlfilter.Automaton(globs).matches([t.encode() for t in texts])
        for k, text in enumerate(texts):
            assert [bool(f) for f in fits[k]] == [bool(pattern(g).fullmatch(text)) for g in globs], (text, globs)


def test_long_rules_fill_several_words():
    glob = "*" + "abcdefg" * 40 + "**"
    automaton = urlfilter.Automaton([glob, "x"])
    assert automaton.words > 4
    assert automaton.matches([("zz" + "abcdefg" * 40 + "/y").encode(), b"x", b""]).tolist() == [[True, False], [False, True], [False, False]]
