import itertools
import math
import random

from avionyx.llm import url_filter
from avionyx.llm.queries import URL_RULES, op7_url_filter


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:n], rest[n:]
    m = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:m]


def brute_rule(host, path):
    fits = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


URLS = [
    None, "", "no scheme.com/x", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/1", "http://example.com/en/", "http://xexample.com/en/",
    "http://a.example.com/en/?q", "http://a.example.net/es/2#f", "http://net/fr/", "http://b.net/fr", "http://c.org?x://y/z", "x://y://z/a",
    "http://casino-win.example.org/en/3", "http://spamfarm.org/a", "http:///path", "http://É.org/ä", "http://a..b.org/", "http://h.org/a\nb?c", "://q.org",
    "http://" + "a" * 5000 + ".org/" + "b" * 9000,
]


def test_hosts_paths_rules_and_edges(spark):
    rows = [(i, u, "<p>the quick house</p>" if i % 2 else None, "x") for i, u in enumerate(URLS)] + [(None, URLS[5], "", "y"), (3, URLS[3], "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = url_filter.judge_urls(pages, URL_RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["page_id"] is None:
            continue
        host, path = brute_parts(URLS[r["page_id"]])
        rule = brute_rule(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule and rule[0] + rule[1])
        assert r["verdict"] == rule[2] if rule else r["verdict"] in ("allow", "block")
        if not host:
            assert r["verdict"] == "allow"
    by_id = {r["page_id"]: r for r in out}
    assert by_id[15]["host_words"][:2] == ["spam", "farm"]
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_every_host_is_scored(spark):
    urls = [("http://спам-казино.example/x", "казино спам"), ("http://casino-казино.org/y", "casino"), ("http://...//", ""), ("http://пример.org/", "пример")]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(urls)], "page_id long, url string, html string")
    out = {r["page_id"]: r for r in url_filter.judge_urls(pages, []).collect()}
    assert out[0]["host_words"] == ["спам", "казино", "example"]
    assert out[1]["host_words"][:2] == ["casino", "казино"]
    assert all(r["block_odds"] is not None for r in out.values())
    assert out[2]["verdict"] == "allow"


def test_viterbi_is_the_best_cut():
    rng = random.Random(0)
    counts = {"a": 9, "ab": 30, "abc": 5, "ca": 12, "bc": 7}
    total = 100

    def value(words):
        return sum(math.log(counts[w]) - math.log(total) if w in counts else (1 - len(w)) * math.log(10) - math.log(total) for w in words)

    for _ in range(200):
        label = "".join(rng.choice("abcx") for _ in range(rng.randrange(1, 9)))
        cuts = []
        for borders in itertools.product([0, 1], repeat=len(label) - 1):
            words, w = [], label[0]
            for b, c in zip(borders, label[1:], strict=True):
                if b:
                    words.append(w)
                    w = c
                else:
                    w += c
            cuts.append(value([*words, w]))
        got = url_filter.cut(label, counts, total)
        assert "".join(got) == label and abs(value(got) - max(cuts)) < 1e-9


def test_unwanted_hosts_are_blocked(spark):
    out = op7_url_filter(spark, "/root/testdata/sf0.01").collect()
    free = [r for r in out if r["rule"] is None]
    bad = [r for r in free if any(w in r["host"] for w in ("casino", "spam-farm", "adult", "bets", "pills", "ads-track"))]
    assert bad and all(r["verdict"] == "block" for r in bad)
    rest = [r for r in free if r not in bad]
    assert sum(r["verdict"] == "block" for r in rest) <= 0.02 * len(rest)


def test_cuts_do_not_depend_on_the_corpus_size(spark):
    hosts = {"winbet": ["win", "bet"], "sexads": ["sex", "ads"], "freebet": ["free", "bet"], "pornxxx": ["porn", "xxx"], "casinowin": ["casino", "win"], "weather": ["weather"]}
    labels = spark.createDataFrame([(h,) for h in hosts], "label string")
    for total in (10**5, 10**6, 10**8, 10**9, 10**10, 10**11):
        words = spark.createDataFrame([("the", total - total // 1000 - 1), ("weather", total // 1000), ("casinowin", 1)], "word string, n long")
        got = {r["label"]: r["words"] for r in url_filter.cut_labels(labels, words).collect()}
        assert got == hosts, total
