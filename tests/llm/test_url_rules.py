"""URL filters against plain Python: parsing, rules, brute-force mining and matching."""

import math
import random
import re
from collections import Counter
from itertools import combinations

from demandloom.llm import url_rules


def parse(url):
    if not url or "://" not in url:
        return "", "", set()
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    query = re.match(r"[^?#]*\?([^#]*)", rest)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    tokens = {"host:" + t for t in host.split(".") if t} | {"path:" + t for t in re.sub("[0-9]+", "#", path).split("/") if t}
    tokens |= {"field:" + t for t in (f.split("=")[0] for f in (query[1] if query else "").split("&")) if t}
    return host, path, tokens | ({"fragment"} if "#" in rest else set())


def ruled(host, path):
    fit = [r for r in url_rules.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def mined(labelled, support, confidence):
    with_label, total = Counter(), Counter()
    for tokens, label in labelled:
        for k in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), k):
                total[part] += 1
                with_label[part, label] += 1
    found = {k: n / total[k[0]] for k, n in with_label.items() if n >= math.ceil(support * len(labelled))}
    keep = {}
    for (part, label), c in found.items():
        shorter = [found.get((part[:i] + part[i + 1:], label)) for i in range(len(part))] if len(part) > 1 else []
        if c >= confidence and not any(s is not None and s >= c for s in shorter):
            keep[part, label] = (c, with_label[part, label])
    return keep


def expected(urls, support=url_rules.MIN_SUPPORT, confidence=url_rules.MIN_CONFIDENCE):
    parts = [parse(u) for u in urls]
    rules = [ruled(h, p) for h, p, _ in parts]
    labelled = [(t, r.verdict) for (_, _, t), r in zip(parts, rules) if r]
    found = mined(labelled, support, confidence)
    common = max(Counter(label for _, label in labelled).items(), key=lambda x: (x[1], x[0]), default=("allow", 0))[0]
    out = []
    for (host, path, tokens), rule in zip(parts, rules):
        best = max(((c, n, len(p), p, label) for (p, label), (c, n) in found.items() if tokens.issuperset(p)), default=None)
        out.append((host, path, rule.text if rule else None, rule.verdict if rule else best[4] if best else common,
                    None if rule or not best else " ".join(best[3])))
    return out


def test_sample_urls(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    rows = sorted(map(tuple, pages.collect()))
    got = sorted(map(tuple, url_rules.filter_urls(pages).collect()))
    assert [r[1:] for r in got] == expected([u for _, u in rows])
    assert {r[4] for r in got} == {"block", "allow"} and any(r[5] for r in got)


def test_odd_urls(spark):
    """Nulls, missing schemes and paths, capitals, look-alike hosts, several "://", line breaks, long URLs, repeated rows and ids."""
    urls = [
        None, "", "no scheme", "http://", "http://NET", "http://a.NET/x", "http://net/", "http://anet/", "http://example.net/en/1", "http://notexample.net/en/1",
        "HTTP://M.Example.Net/en/?a=1&b&&=2#f", "http://example.net/EN/", "http://example.com/de/1", "http://www.example.com/de", "http://x.org/fr/a", "http://x.org/fr",
        "x://a.net?b://c.org/fr/", "://b.net/", "http://a.com/p?u=http://b.net/", "http://É.net/Ä/", "http://a.net\n/en/\n?x\n=1", "http://a..net//", "ftp://a.org#x?y",
        "http://a.net/" + "/".join(f"seg{chr(97 + i % 26)}{i}" for i in range(3000)),
    ]
    rng = random.Random(3)
    urls += [f"http://{rng.choice('abc')}.{rng.choice(['net', 'org', 'com', 'example.net'])}/{rng.choice(['en', 'fr', 'de'])}/{i}" for i in range(150)] + urls[1:9]
    urls = [u for u in urls if u is None or len(u) < 1000] + [urls[23]]
    ids = [i % 140 if i % 9 else None for i in range(len(urls))]
    df = spark.createDataFrame(list(zip(ids, urls, ["x"] * len(ids), ["y"] * len(ids))), "page_id long, url string, tokens string, rule string")
    got = [tuple(r) for r in url_rules.filter_urls(df).collect()]
    want = expected([u for u in urls[:-1]])  # the long one is compared by its rule alone: it is too wide for brute force
    have = Counter(r[1:4] for r in got)
    assert have == Counter([w[:3] for w in want] + [(*parse(urls[-1])[:2], "net/")])
    assert sum(r[0] is None for r in got) == sum(i is None for i in ids)
    empty = df.limit(0)
    assert url_rules.filter_urls(empty).count() == 0


def test_nothing_labelled(spark):
    df = spark.createDataFrame([(1, "http://a.com/en/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_rules.filter_urls(df).collect()} == {"allow"}


def test_own_labels(spark):
    rng = random.Random(4)
    sites = ["good", "bad"]
    labels = [(f"http://{rng.choice('ab')}.{s}.com/{rng.choice(['x', 'y'])}/{i}", "block" if s == "bad" else "allow") for i in range(200) for s in sites]
    pages = spark.createDataFrame([(1, "http://z.bad.com/x/"), (2, "http://z.good.com/y/"), (3, "http://bad.com/?q")], "page_id long, url string")
    got = {r.page_id: (r.verdict, r.mined) for r in url_rules.filter_urls(pages, labels=spark.createDataFrame(labels, "url string, label string")).collect()}
    assert got == {1: ("block", "host:bad"), 2: ("allow", "host:good"), 3: ("block", "host:bad")}


def test_mining_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["block", "allow", "allow"]), sorted(rng.sample("abcdefg", rng.randint(0, 6)))) for _ in range(400)]
    rows = [(("block" if {"a", "b"} <= set(t) else v), t) for v, t in rows]
    got = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in url_rules.mine(
        spark.createDataFrame(rows, "label string, tokens array<string>"), 0.02, 0.8).collect()}
    assert got == mined([(set(t), v) for v, t in rows], 0.02, 0.8)


def test_wide_baskets_keep_telling_tokens(spark):
    rows = [("block" if i % 2 else "allow", sorted([f"t{j:02d}" for j in range(30)] + (["mark"] if i % 2 else []))) for i in range(40)]
    got = url_rules.mine(spark.createDataFrame(rows, "label string, tokens array<string>"), 0.1, 0.9).collect()
    assert [(r.tokens, r.verdict, r.support) for r in got] == [(["mark"], "block", 20)]


def test_wide_baskets_are_mined_whole(spark):
    """Verdicts that hang on tokens which tell little alone, in rows of more than 12 tokens, beside short rows and a very wide one."""
    rng = random.Random(6)
    rows = []
    for _ in range(150):
        t = sorted(rng.sample("abcdefghijklmn", rng.choice([2, 5, 12, 13, 14])))
        rows.append(("block" if len({"a", "b", "c"} & set(t)) == 2 and "n" in t else "allow", t))
    got = {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in url_rules.mine(
        spark.createDataFrame(rows, "label string, tokens array<string>"), 0.1, 0.4).collect()}
    want = mined([(set(t), v) for v, t in rows], 0.1, 0.4)
    assert got == want and any(len(t) > 1 for t, _ in want)

    often = [(v, t + [f"x{i:04d}" for i in range(2000)] if not n else t) for n, (v, t) in enumerate(rows)]
    wide = url_rules.mine(spark.createDataFrame(often, "label string, tokens array<string>"), 0.1, 0.4).collect()
    assert {(tuple(r.tokens), r.verdict): (r.confidence, r.support) for r in wide} == want
