import random

import numpy as np

from layerkit.llm import link_trust as L


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host int, rule string, r string").repartition(3)


def brute_scores(links, seeds):
    hosts = sorted({h for a, b, _ in links for h in (a, b)} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    n = np.zeros((len(hosts),) * 2)
    for a, b, k in links:
        n[at[a], at[b]] += k
    out = []
    for side, m in ((0, n), (1, n.T)):
        share = np.divide(m, m.sum(1, keepdims=True), out=np.zeros_like(m), where=m.sum(1, keepdims=True) > 0)
        base = np.array([seeds.get(h, (0, 0))[side] for h in hosts]) * (1 - L.DAMPING)
        s = base.copy()
        for _ in range(L.ROUNDS):
            s = base + L.DAMPING * share.T @ s
        out.append(dict(zip(hosts, s)))
    return out


def test_propagation_against_numpy(spark):
    r = random.Random(3)
    links = {}
    for _ in range(160):
        a, b = f"h{r.randint(0, 30)}", f"h{r.randint(0, 30)}"
        if a != b:
            links[(a, b)] = r.randint(1, 9)
    links = [(a, b, n) for (a, b), n in links.items()]
    seeds = {f"h{i}": (float(i % 2), float(i % 2 == 0)) for i in range(8)}
    got = L.propagate(spark.createDataFrame(links, "src string, dst string, n long"),
                      spark.createDataFrame([(h, *x) for h, x in seeds.items()], "host string, trust double, distrust double"))
    trust, distrust = brute_scores(links, seeds)
    for x in got.collect():
        assert abs(x.trust - trust[x.host]) < 1e-9 and abs(x.distrust - distrust[x.host]) < 1e-9


def test_links_and_rules(spark):
    a = '<A class="x" HREF="http://B.example.net/p?q">x</a> <a href=\'//c.org\'>y</a> <a href=/local>z</a><a href="mailto:x@y.z">m</a><link href="http://no.net">'
    rows = [
        (1, "http://Trusted.example.org/fr/1?x=/es/", a, 1, "", None),
        (2, "https://www.example.org/es/x#y", '<a href="https://ring.net/">r</a>', 1, "", None),
        (3, "https://example.org/en/12", "", 1, "", None), (4, "https://example.org/en/2", None, 1, "", None),
        (5, "http://b.example.net/q", None, 1, "", None), (6, "https://ring.net/", '<a href="http://www.bad.com/de/x">b</a>', 1, "", None),
        (7, "http://www.bad.com/de/x", "", 1, "", None), (8, "http://www.bad.com/en/", "", 1, "", None), (9, None, None, None, None, None),
        (10, "no scheme", "", 1, "", None), (11, "http://a.com?u=http://b.org/", "", 1, "", None), (12, "x://notorg/", "", 1, "", None),
        (None, "http://b.example.net/q", None, 1, "", None), (5, "http://b.example.net/q", None, 1, "", None),
    ]
    got = L.judge(pages_of(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {x.page_id: x for x in got}
    assert [(by[i].host, by[i].path, by[i].rule, by[i].verdict) for i in (1, 2, 3, 4)] == [
        ("trusted.example.org", "/fr/1", "org/", "allow"), ("www.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/en/2", "org/", "allow"),
    ]
    assert by[5].rule is None and by[5].verdict == "allow" and by[5].trust > 0  # linked from a trusted host
    assert by[6].verdict == "block" and by[6].distrust > 0  # links to a blocked host
    assert (by[7].rule, by[7].verdict, by[8].rule, by[8].verdict) == ("com/de/", "block", None, "block")
    assert (by[9].host, by[9].path, by[9].verdict) == (by[10].host, by[10].path, by[10].verdict) == ("", "", "allow")
    assert (by[11].host, by[11].path, by[12].host) == ("a.com", "", "notorg")
    assert by[12].rule is None
    links = {(x.src, x.dst): x.n for x in L.host_links(pages_of(spark, rows)).collect()}
    assert links == {("trusted.example.org", "b.example.net"): 1, ("trusted.example.org", "c.org"): 1,
                     ("www.example.org", "ring.net"): 1, ("ring.net", "www.bad.com"): 1}


def test_empty(spark):
    assert L.judge(pages_of(spark, [])).count() == 0


def test_fixed_point_of_a_graph_with_cycles(spark):
    """Against a linear system; 20 rounds are up to 4 % short of it."""
    r = random.Random(4)
    links = {(f"h{r.randint(0, 9)}", f"h{r.randint(0, 9)}"): r.randint(1, 9) for _ in range(40)}
    links = [(a, b, n) for (a, b), n in links.items() if a != b]
    seeds = {"h0": (1.0, 0.0), "h1": (0.5, 0.5), "h2": (0.0, 1.0)}
    got = L.propagate(spark.createDataFrame(links, "src string, dst string, n long"),
                      spark.createDataFrame([(h, *x) for h, x in seeds.items()], "host string, trust double, distrust double"), rounds=None)
    m = np.zeros((10, 10))
    for a, b, k in links:
        m[int(a[1:]), int(b[1:])] = k
    want = []
    for side, w in ((0, m), (1, m.T)):
        share = np.divide(w, w.sum(1, keepdims=True), out=np.zeros_like(w), where=w.sum(1, keepdims=True) > 0)
        start = np.array([seeds.get(f"h{i}", (0, 0))[side] for i in range(10)])
        want.append(np.linalg.solve(np.eye(10) - L.DAMPING * share.T, (1 - L.DAMPING) * start))
    rows = got.collect()
    assert len(rows) == 10
    for x in rows:
        assert abs(x.trust - want[0][int(x.host[1:])]) < 1e-11 and abs(x.distrust - want[1][int(x.host[1:])]) < 1e-11


def test_hosts_far_from_a_seed_are_judged(spark):
    """A chain of 50 links to a blocked host."""
    rows = [(i, f"https://far{i}.net/", f'<a href="https://far{i - 1}.net/">x</a>' if i > 1 else '<a href="https://bad.com/de/">x</a>', 1, "", None)
            for i in range(1, 51)]
    got = L.judge(pages_of(spark, rows + [(0, "https://bad.com/de/", "", 1, "", None)])).collect()
    assert {x.verdict for x in got} == {"block"} and all(x.page_id == 0 or x.distrust > 0 for x in got)
