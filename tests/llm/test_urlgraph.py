import random
import re

from slicerefresh.llm import urlgraph as op


def host(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest)[0])


def path(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    return re.match(r"[^/?#]*([^?#]*)", rest)[1]


def rule_of(h, p):
    fits = [(len(on + start), on + start, verdict) for verdict, on, start in op.RULES if (h == on or h.endswith("." + on)) and p.startswith(start)]
    return max(fits)[1:] if fits else (None, None)


def rank(edges, seeds):
    total = sum(seeds.values())
    if not total:
        return {}
    out = {}
    nodes = {x for e in edges for x in e} | set(seeds)
    links = dict(edges)
    for n in nodes:
        if not any(a == n for a, _ in edges):
            links[n, n] = 1
    for (a, _), w in links.items():
        out[a] = out.get(a, 0) + w
    seed = {h: w * op.UNITS // total for h, w in seeds.items()}
    mass, reached = dict(seed), {h for h, m in seed.items() if m}
    while True:
        before, known = mass, set(reached)
        for _ in range(op.STEPS):
            new = {h: m * 15 // 100 for h, m in seed.items()}
            for (a, b), w in links.items():
                if a in mass:
                    d = 100 * out[a]
                    new[b] = new.get(b, 0) + mass[a] // d * 85 * w + mass[a] % d * 85 * w // d
            mass = new
        reached |= {h for h, m in mass.items() if m}
        if reached == known and all(abs(mass.get(h, 0) - before.get(h, 0)) <= op.SETTLED for h in {*mass, *before}):
            return mass


def judge(pages):
    edges, allow, block, rows = {}, {}, {}, []
    for page, url, html in pages:
        h, p = host(url), path(url)
        rule, verdict = rule_of(h, p)
        rows.append((page, h, p, rule, verdict))
        if verdict and h:
            seeds = allow if verdict == "allow" else block
            seeds[h] = seeds.get(h, 0) + 1
        for href in set(re.findall(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)", html or "")):
            to = host(href) if "://" in href else host("http:" + href) if href.startswith("//") else h
            if h and to:
                edges[h, to] = edges.get((h, to), 0) + 1
    trust, distrust = rank(edges, allow), rank({(b, a): w for (a, b), w in edges.items()}, block)
    out = []
    for page, h, p, rule, verdict in rows:
        t, d = trust.get(h, 0), distrust.get(h, 0)
        out.append((page, h, p, rule, verdict or ("block" if d > t else "allow"), t, d))
    return out


def check(df):
    expected = judge([(r.page_id, r.url, r.html) for r in df.collect()])
    got = [tuple(r) for r in op.judge(df).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    return expected


def test_matches_plain(spark):
    rows = check(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    assert {r[4] for r in rows} == {"allow", "block"}


def test_links_carry_trust_and_distrust(spark, monkeypatch):
    monkeypatch.setattr(op, "SETTLED", op.UNITS // 1000)  # fewer steps
    rnd = random.Random(4)
    hosts = [f"h{k}.{tld}" for k in range(12) for tld in ("com", "net", "org")]
    pages = []
    for k in range(300):
        links = " ".join(f'<a class=x href="http://{rnd.choice(hosts)}/p?{k}">l</a><A HREF=/rel{k}>r</A><a href="//{rnd.choice(hosts)}">s</a>' for _ in range(rnd.randrange(3)))
        pages.append((k, f"https://{rnd.choice(hosts)}/{rnd.choice(('es', 'en', 'fr'))}/{k}", f"<html>{links}"))
    rows = check(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3))
    org = {r[4] for r in rows if r[1].endswith("org")}
    assert org == {"allow", "block"}


def test_edge_rows(spark):
    pages = [
        (1, None, None, 1, "r"),
        (2, "no scheme", "<a href='http://x.com'>", 1, None),
        (3, "http://", "", 1, "r"),
        (4, "HTTP://WWW.Example.COM/en/x?y#z", "<a href=#top>", None, "r"),
        (5, "http://example.com/en/", None, 1, "r"),
        (6, "http://example.com/EN/", None, 1, "r"),
        (7, "x://a.net?/es/", None, 1, "r"),
        (8, "x://a.net/es/://b.com/", "long " * 100_000, 1, "r"),
        (8, "x://a.net/es/://b.com/", "long " * 100_000, 1, "r"),
        (None, "http://notexample.com/en/", None, 1, "r"),
        (9, "http://com/", None, 1, "r"),
        (10, "http://é.org/\nfr/", None, 1, "r"),
    ]
    schema = "page_id long, url string, html string, trust int, rule string"
    df = spark.createDataFrame(pages, schema).repartition(2)
    expected = judge([p[:3] for p in pages])
    assert sorted((tuple(r) for r in op.judge(df).collect()), key=str) == sorted(expected, key=str)
    by = {r[0]: r for r in expected}
    assert by[4][3:5] == ("www.example.com/en/", "allow") and by[5][3:5] == ("example.com/en/", "block") and by[6][3] == "com/"
    assert by[1][1:5] == ("", "", None, "allow") and by[7][3] is None and by[8][3:5] == ("net/es/", "block")
    assert op.judge(spark.createDataFrame([], schema)).count() == 0


def test_a_long_chain_is_followed_to_its_end(spark, monkeypatch):
    """Forty hosts, each linking to the next, the last to a blocked one: distrust reaches them all."""
    monkeypatch.setattr(op, "SETTLED", op.UNITS // 100)  # hosts that are reached keep the steps going
    pages = [(k, f"http://hop{k}.org/", f"<a href='http://hop{k + 1}.org/'>") for k in range(40)]
    pages += [(40, "http://hop40.org/", "<a href='http://bad.net/es/'>"), (41, "http://bad.net/es/", None), (42, "http://clean.org/", None)]
    expected = check(spark.createDataFrame(pages, "page_id long, url string, html string"))
    verdicts = {r[0]: r[4] for r in expected}
    assert all(verdicts[k] == "block" for k in range(42)) and verdicts[42] == "allow"
    assert all(r[6] > 0 for r in expected if r[0] < 42)
