import random
import re
from collections import Counter, defaultdict
from statistics import mean

from dayledger.llm import url_filters
from dayledger.llm.queries import QUERIES
from dayledger.llm.url_filters import RULES, Rule

NO_RULES = (Rule("nowhere.invalid/", "block"),)


def test_rules_against_brute_force(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()}
    got = QUERIES["op2_url_filters"](spark, sf_dir).collect()
    assert len(got) == len(urls)
    for r in got:
        assert_ruled(urls[r.page_id], r)


def assert_ruled(url, r):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [x for x in RULES for h, _, p in [x.text.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    best = max(fits, key=lambda x: len(x.text), default=None)
    assert (r.host, r.path) == (host, path)
    assert r.rule == (best and best.text)
    assert best is None or r.verdict == best.verdict


def test_edge_urls(spark):
    urls = [
        None, "", "no scheme/x", "://", "http://", "http://NET/", "http://a.NeT", "http://xnet/", "http://a.net?q=/x",
        "http://example.net/en/1", "http://example.net/en", "http://a.example.com/de/x#y", "x://y://example.com/de/",
        "http://Ä.example.org/fr/a//b", "http://org/fr/", "http://example.net/en/1",
    ]
    rows = [(n, u, "x", "y", "z") for n, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, template string")
    got = url_filters.judged(pages).collect()
    assert len(got) == len(urls)
    for r in got:
        assert_ruled(urls[r.page_id], r)
    assert url_filters.judged(pages.where("false")).collect() == []


def verdicts(spark, rows):
    pages = spark.createDataFrame([(n, u, b) for n, (u, b) in enumerate(rows)], "page_id long, url string, bad int")
    out = url_filters.judged(pages, NO_RULES, pages.where("bad is not null").select("page_id", "bad"))
    return {(r.host, r.template): r.verdict for r in out.collect()}


def test_pure_templates_go_and_merged_siblings_share_labels(spark):
    rows = [(f"http://a.x/news/{k}.html", 0) for k in range(30)] + [(f"http://a.x/spam/{k}", 1) for k in range(30)]
    rows += [(f"http://a.x/mixed/{k}", k % 2) for k in range(30)]
    rows += [("http://a.x/spim/1", 1), ("http://a.x/spim/2", None), ("http://a.x/open/7", None)]
    got = verdicts(spark, rows)
    assert got == {
        ("a.x", "/news/*"): "allow", ("a.x", "/spam/*"): "block", ("a.x", "/mixed/*"): "allow",
        ("a.x", "/spim/*"): "block", ("a.x", "/open/*"): "allow",
    }
    alone = verdicts(spark, [("http://b.x/spim/1", 1), ("http://b.x/spim/2", None)])
    assert alone == {("b.x", "/spim/*"): "allow"}  # one label is no evidence


def test_wide_parents_become_wildcards(spark):
    names = [f"tag{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40)]
    rows = [(f"http://a.x/{n}/list", 1) for n in names] + [("http://b.x/one/list", 1)]
    got = verdicts(spark, rows)
    assert {v for (h, _), v in got.items() if h == "a.x"} == {"block"}
    assert got["b.x", "/one/list"] == "allow"


def test_stays_in_the_jvm(spark, sf_dir):
    assert "Python" not in QUERIES["op2_url_filters"](spark, sf_dir)._jdf.queryExecution().toString()


def by_brute_force(pages):
    """Verdicts by (host, template) of pages (host, path, fixed, bad), one branch at a time."""
    prior, wide, own_share, z = url_filters.PRIOR_PAGES, url_filters.VARIABLE, url_filters.OWN_SHARE, url_filters.SAME_WITHIN
    sums = defaultdict(lambda: [0, 0, 0, set()])
    for host, path, fixed, bad in pages:
        segments = tuple("*" if i > fixed and re.match(r"\d|.*\d.*\d", s) else s for i, s in enumerate(path.split("/")))
        one = sums[host, fixed, segments]
        one[0] += bad or 0
        one[1] += bad is not None
        one[2] += 1
        one[3].add(path)
    tree = {key: key[2] for key in sums}
    for depth in range(1, max(map(len, tree.values()))):
        children = Counter()
        for key, segments in tree.items():
            if len(segments) > depth:
                children[key[0], segments[:depth], segments[depth]] += sums[key][2]
        total, kinds = Counter(), Counter()
        for (host, parent, _), n in children.items():
            total[host, parent] += n
            kinds[host, parent] += 1
        for key, segments in tree.items():
            if len(segments) > depth > key[1]:
                at = key[0], segments[:depth]
                heavier = total[at] + prior
                if kinds[at] / heavier > wide and children[(*at, segments[depth])] / heavier < own_share:
                    tree[key] = (*segments[:depth], "*", *segments[depth + 1 :])
    branches = defaultdict(lambda: [0, 0, 0, 0])
    for key, segments in tree.items():
        for i, v in enumerate((sums[key][0], sums[key][1], sums[key][2], len(sums[key][3]))):
            branches[key[0], segments][i] += v
    around = defaultdict(list)
    for host, segments in branches:
        named = max((i for i, s in enumerate(segments) if s not in ("*", "")), default=-1)
        around[host, tuple("?" if i == named else s for i, s in enumerate(segments))].append((host, segments))
    labels = {}
    for group in around.values():
        clusters, last = [], None
        for key in sorted((k for k in group if branches[k][1]), key=lambda k: (branches[k][0] / branches[k][1], "/".join(k[1]))):
            bad, n, _, _ = branches[key]
            smooth = (bad + 1) / (n + 2)
            if last is None or bad / n - last > z * (smooth * (1 - smooth) / n) ** 0.5:
                clusters.append([])
            clusters[-1].append(key)
            last = bad / n
        known = []
        for cluster in clusters:
            bad, n, pages_, paths = (sum(branches[k][i] for k in cluster) for i in range(4))
            known.append((mean(branches[k][2] for k in cluster), bad / n, paths / pages_, bad, n))
            labels |= {k: (bad, n) for k in cluster}
        for key in group:
            bad, n, pages_, paths = branches[key]
            if n or not known:
                continue
            m, _, share, *found = min(known, key=lambda c: (abs(c[0] ** 0.5 - pages_**0.5), c[0] > pages_, c[1] if c[0] > pages_ else -c[1]))
            own = (share * m + paths) / (m + pages_)
            error = (own * (1 - own) * (1 / m + 1 / pages_)) ** 0.5
            if abs(m**0.5 - pages_**0.5) * 2**0.5 <= z and abs(share - paths / pages_) <= z * error + 1e-9:
                labels[key] = tuple(found)
    domains = defaultdict(lambda: [0, 0])
    for (host, segments), (bad, n, _, _) in branches.items():
        domains[tuple(host.split(".")[-2:]), segments][0] += bad
        domains[tuple(host.split(".")[-2:]), segments][1] += n
    out = {}
    for key, segments in tree.items():
        bad, n = labels.get((key[0], segments)) or domains[tuple(key[0].split(".")[-2:]), segments]
        out[key[0], "/".join(key[2]), key[1]] = (bad + prior * url_filters.PRIOR_BAD) / (n + prior) >= url_filters.REJECT
    return out


def assert_like_brute_force(spark, pages):
    rows = spark.createDataFrame(pages, "host string, path string, fixed int, bad int")
    got = {(r.host, r.template, r.fixed): r.rejected for r in url_filters.template_verdicts(rows).collect()}
    assert got == by_brute_force(pages)
    return got


def test_verdicts_against_brute_force(spark):
    draw = random.Random(5)
    pages = []
    for host in ("a.one.com", "b.one.com", "c.two.org"):
        for name in ("de", "en", "fr", "x/y", "tags"):
            share = draw.choice([0, 0.5, 1, 1, None, None])
            for _ in range(draw.choice([3, 12, 13, 40])):
                tail = draw.choice(["17", "a1b2.html", "list", "a/7"]) if name != "tags" else f"t{draw.choice('abcdefgh') * draw.randint(1, 9)}"
                bad = None if share is None or draw.random() < 0.2 else int(draw.random() < share)
                pages.append((host, f"/{name}/{tail}", 1 if name == "de" else 0, bad))
    got = assert_like_brute_force(spark, pages)
    assert set(got.values()) == {True, False}


def test_the_method_blocks_and_keeps_pages_without_a_rule(spark):
    """Beside a rejected branch: one like it goes, a larger and a much re-read one stay."""
    rows = [(f"http://a.example.com/de/{k}", "block") for k in range(20)]
    rows += [(f"http://a.example.com/fr/{k}", "block") for k in range(19)]
    rows += [(f"http://a.example.com/en/{k}", "allow") for k in range(90)]
    rows += [(f"http://a.example.com/es/{k % 4}", "allow") for k in range(20)]
    rows += [("http://b.example.com/it/1", "allow")]
    pages = spark.createDataFrame([(n, u) for n, (u, _) in enumerate(rows)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filters.judged(pages).collect()}
    assert [got[n][1] for n in range(len(rows))] == [v for _, v in rows]
    assert {got[n][0] for n in range(20)} == {"example.com/de/"} and {got[n][0] for n in range(20, len(rows))} == {None}


def test_given_pages_against_brute_force(spark, sf_dir):
    got = QUERIES["op2_url_filters"](spark, sf_dir).collect()
    fixed = {None: 0, **{r.text: len([s for s in r.text.split("/")[1:] if s]) for r in RULES}}
    bad = {None: None, **{r.text: int(r.verdict == "block") for r in RULES}}
    wanted = by_brute_force([(r.host, r.path, fixed[r.rule], bad[r.rule]) for r in got])
    for r in got:
        if r.rule is None:
            assert r.verdict == ("block" if wanted[r.host, r.template, 0] else "allow")
