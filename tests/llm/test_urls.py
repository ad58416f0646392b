"""URL rules against plain comparisons, and the cascade against sets."""

import random

import numpy as np
import pytest

from paytide.llm import urlfilter
from paytide.llm.frames import importable, staged

URLS = [
    None,
    "",
    "no scheme/en/",
    "http://",
    "http://WWW.Example.COM/en/1?x=/fr/",
    "https://example.com",
    "https://example.com?/en/",
    "https://example.com/EN/",
    "http://badexample.com/en/a",
    "http://a.b.example.com/en",
    "x http://com/ http://example.com/en/",
    "http://é.net/es/\n/q",
    "http://example.com./en/",
    "http://example.com/en/" + "y" * 50_000,
]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]


def judged(url, rules):
    host, path = parsed(url)
    fits = [
        (len(h) + len(p), len(h), a, h + p)
        for h, p, a in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    return host, path, max(fits)[3], max(fits)[2]


@pytest.mark.parametrize("segment_keys", [40, 10_000_000])
def test_equals_plain_comparison(spark, segment_keys):
    importable(spark)
    draw = random.Random(7)
    labels = ["com", "net", "example", "www", "a", "b", "É"]
    hosts = [".".join(draw.choices(labels, k=draw.randint(1, 4))) for _ in range(120)]
    paths = ["", "/", "/e", "/en/", "/en/x", "/fr/long/way"]
    rules = [(draw.choice(hosts), draw.choice(paths), draw.choice(["allow", "block"])) for _ in range(90)]
    rules += [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]
    urls = URLS + [
        f"http://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', 'z', '/en/', '?q', '#t'])}" for _ in range(600)
    ]
    urls += urls[-300:] + [urls[-1]] * 200
    rows = [(i if i % 9 else None, u, "own", 5) for i, u in enumerate(urls)]
    df = staged(spark.createDataFrame(rows, "page_id long, url string, host string, ones int"))
    odd = [(None, "/", "block"), ("com", None, "block"), ("com", "/", "other"), *rules[:5]]
    listed = spark.createDataFrame(rules + odd, "host string, path string, action string")
    got = urlfilter.judge_urls(df, listed, segment_keys=segment_keys)
    assert got.columns == ["page_id", "url", "ones", "host", "path", "rule", "verdict"]
    assert sorted(map(str, ((r.page_id, r.url, r.ones, r.host, r.path, r.rule, r.verdict) for r in got.collect()))) == sorted(
        str((i, u, 5, *judged(u, rules))) for i, u, _, _ in rows
    )


def test_no_rules_and_no_urls(spark):
    importable(spark)
    df = staged(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"))
    rules = staged(spark.createDataFrame([("com", "/", "block")], "host string, path string, action string"))
    assert urlfilter.judge_urls(df, rules.filter("false")).first().verdict == "allow"
    assert urlfilter.judge_urls(df, rules.filter("false"), otherwise="block").first().verdict == "block"
    assert urlfilter.judge_urls(df.filter("false"), rules).count() == 0
    assert urlfilter.judge_urls(df, rules).first().rule == "com/"


def test_cascade_is_exact_over_its_universe(spark):
    importable(spark)
    keys = spark.range(60_000).selectExpr("xxhash64(id) AS h1", "xxhash64(1, id) AS h2", "id")
    listed = staged(keys.filter("id % 7 = 0"))
    cascade = urlfilter.build_cascade(listed, keys.union(keys))
    all_keys = keys.toPandas()
    known = cascade.listed(all_keys.h1.to_numpy(), all_keys.h2.to_numpy())
    assert (known == (all_keys.id % 7 == 0)).all() and len(cascade.levels) > 3
    # Less than a tenth of what the listed keys themselves would take.
    assert sum(level.n_bits for level in cascade.levels) < 16 * 8 * (known.sum() / 10)
    assert not urlfilter.build_cascade(listed.filter("false"), keys).listed(*np.ones((2, 3), np.int64)).any()
