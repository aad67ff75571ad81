import numpy as np
import pytest

from eventlake.llm import urlfilter

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "a.b.io/"), ("allow", "b.io/x/"), ("block", "bare.de")]


def brute(url):
    rest = (url or "").partition("://")[2]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fit = []
    for verdict, rule in RULES:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fit.append((len(rule), len(h), rule, verdict))
    _, _, rule, verdict = max(fit, default=(0, 0, None, "allow"))
    return host, path, rule, verdict


@pytest.mark.parametrize("shard_rows", [2, 1000])
def test_judge_equals_brute_force(spark, rng, shard_rows):
    hosts = ["net", "example.net", "EXAMPLE.net", "x.example.net", "xexample.net", "example.com", "org", "a.org", "a.b.io", "z.a.b.io", "b.io", "bare.de", "www.bare.de", "ÄBC.net", "", ".", "net.", "u@net:80", "a..net", "." * 5000 + "net", "h" * 100000]
    paths = ["", "/", "/en", "/en/", "/en/x", "/de/?a=/en/", "/fr/#x", "?q", "#f", "/x/y", "//en/", "/" + "p" * 50000]
    urls = [s + h + p for s in ("http://", "", "://", "x://y://") for h in hosts for p in paths] + [None, "", "://", "http:/net/"]
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate([*urls, *urls[:5]])], "page_id bigint, url string, host string")
    index = urlfilter.build(urlfilter.rule_table(spark, RULES), shard_rows=shard_rows)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, index).collect()}
    for k, u in enumerate([*urls, *urls[:5]]):
        assert got[k] == brute(u), u


def test_equal_digests_are_told_apart(monkeypatch, spark):
    index = urlfilter.build(urlfilter.rule_table(spark, RULES))
    probe = urlfilter.Probe(index)
    own, ends, rules, block = probe._shard(0)
    probe.shards[0] = (np.full(len(own), 5, np.uint64), ends, rules, block)
    probe.bounds = np.array([0], np.uint64)
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda _: 5)
    assert probe.verdicts(["net/", "org/fr/", "other/"]) == [True, False, None]


def test_empty(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    index = urlfilter.build(urlfilter.rule_table(spark, RULES).where("false"))
    assert urlfilter.judge(none, index).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert urlfilter.judge(one, index).first().verdict == "allow"
