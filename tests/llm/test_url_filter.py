from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from dispersa.llm import text as T
from dispersa.llm import url_filter as U
from dispersa.llm.queries import URL_RULES

URLS = ["https://WWW.Good.Example.org/en/5", "http://example.org/en/12?x=/a", "http://example.org/es/1", "http://a.example.org/es",
        "http://org", "http://org/", "http://forg/x", "http://x.com/fr/1#y", "http://x.com/de/2", "http://x.com/dex", "plain/text",
        "", None, "ftp://h.net?q#f", "http://spam-farm.com/de/9", "http://spam-farm.com/xx/9", "http://x.com/en/?u=http://y.org/"]


def brute(url):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    best = None
    for r in URL_RULES:
        h, _, p = r.text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.text) > len(best.text)):
            best = r
    return host, path, best


def test_rules_match_brute_force(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS * 3)]
    out = U.filter_urls(spark.createDataFrame(rows, "page_id long, url string, rule string"), URL_RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule = brute(rows[r.page_id][1])
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        assert r.verdict == (rule.verdict if rule else "allow" if r.score >= r.threshold else "block")


def test_scores_match_a_plain_model(spark, monkeypatch):
    """Counts in dictionaries instead of hashed cells (here so many that hardly any is shared)."""
    rows = [(i, f"http://{h}.org/{w}/{i}") for i, (h, w) in enumerate([("ab", "xy"), ("ba", "yx"), ("aa", "xx")] * 4)]
    rows += [(100 + i, f"http://spam.com/de/{i}") for i in range(9)] + [(200, "http://spam.net/q"), (201, "http://ab.net/x")]
    side = [0 if i < 100 else 1 for i, _ in rows if i < 200]
    urls = spark.createDataFrame([(u.split("://")[1], s, i % 2) for (i, u), s in zip(rows, side)], "text string, side int, half int")
    trained = U.train(urls)
    assert sum(m.gram.sum() for m in trained) == sum(len(u) - 7 for i, u in rows if i < 200) * (U.ORDER + 1)

    monkeypatch.setattr(U, "SLOTS", 1 << 21)
    count2 = np.zeros((2, 2, U.SLOTS))
    for (_, u), s in zip(rows, side):
        gram, context, _ = U._grams(next(T.slices(pa.array([u.split("://")[1]]))))
        np.add.at(count2[0, s], gram.ravel(), 1)
        np.add.at(count2[1, s], context.ravel(), 1)
    part = next(T.slices(pa.array([u.split("://")[1] for _, u in rows])))
    got = dict(zip((i for i, _ in rows), U.Models(count2[0], count2[1]).scores(part)))

    def grams(url):
        s = url.split("://", 1)[1].encode()
        for i, b in enumerate(s):
            for o in range(U.ORDER + 1):
                context = tuple(s[i - k] if i >= k else -1 for k in range(1, o + 1))
                yield i, o, b, context

    count = [{}, {}]
    for _, url in rows:
        rule = brute(url)[2]
        if rule:
            c = count[rule.verdict == "block"]
            for _, o, b, x in grams(url):
                c[(o, b, x)] = c.get((o, b, x), 0) + 1
                c[(o, x)] = c.get((o, x), 0) + 1
    for i, url in rows:
        size = len(url.split("://", 1)[1])
        total = 0.0
        for side, sign in ((0, 1), (1, -1)):
            p = {}
            for at, o, b, x in grams(url):
                c = count[side]
                p[at] = (c.get((o, b, x), 0) + U.BLEND * p.get(at, 1 / 256)) / (c.get((o, x), 0) + U.BLEND)
            total += sign * sum(np.log10(v) for v in p.values())
        assert abs(got[i] - total / size) < 1e-6


def test_without_decided_urls_and_empty(spark):
    out = U.filter_urls(spark.createDataFrame([(1, "http://a.net/x"), (1, None)], "page_id long, url string"), URL_RULES).collect()
    assert [(r.verdict, r.score) for r in out] == [("allow", 0.0)] * 2
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_very_long_url():
    part = next(T.slices(pa.array(["http://x.org/" + "a" * 100_000])))
    gram, _, rows = U._grams(part)
    assert gram.shape == (U.ORDER + 1, 100_013) and rows.max() == 0
