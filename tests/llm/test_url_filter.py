import random
import re

from tickloom.llm import url_filter as U


def pages(spark, urls, extra=True):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return frame.selectExpr("*", "'x' as host", "'y' as rule", "'<a>' as html") if extra else frame


def test_globs_match_a_regular_expression():
    rng = random.Random(1)
    for _ in range(150):
        part = lambda n: "".join(rng.choice("ab.*?é") for _ in range(rng.randrange(0, n)))
        rules = [U.Rule("block", part(6), "/" + part(40 if k == 0 else 5)) for k in range(rng.choice([1, 3, 30]))]
        made = U.RuleSet(rules)
        hosts = ["".join(rng.choice("ab.é") for _ in range(rng.randrange(0, 8))) for _ in range(20)]
        paths = ["".join(rng.choice("/ab.é") for _ in range(rng.randrange(0, 12))) for _ in range(20)]

        def fits(rule, host, path):
            h = re.escape(rule.host).replace(r"\*", "[^/]*").replace(r"\?", "[^/]")
            p = re.escape(rule.path).replace(r"\*", ".*").replace(r"\?", "[^/]")
            return re.fullmatch(rf"(?:[^/]*\.)?{h}", host, re.S) and re.match(p, path, re.S)

        for h, p, w in zip(hosts, paths, made.winners(hosts, paths).tolist()):
            want = next((i for i, r in enumerate(made.rules) if fits(r, h, p)), -1)
            assert w == want, (made.rules[want], h, p)


def test_contract_rules(spark):
    urls = [
        "https://www.example.com/en/x?q#f", "http://Blog.Example.COM/en/", "http://example.com/en", "https://a.b.net/es/1", "http://net/fr/",
        "http://xnet/fr/", "http://example.com", "no url", None, "", "://", "a://b://c/d", "http://example.com?x=/en/", "http://e.net/a.example.com/en/",
        "HTTP://ÉX.net/es/é", "http://www.example.com/en/" + "z" * 300_000, "http://example.com/en/\n2",
    ]
    got = {r["page_id"]: r for r in U.judge_urls(pages(spark, urls), [U.parse_rule(r) for r in U.RULES]).collect()}
    assert len(got) == len(urls)
    rules = [U.parse_rule(r) for r in U.RULES]
    for i, url in enumerate(urls):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.name), default=None)
        r = got[i]
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == ((best.name, best.verdict) if best else (None, "allow"))


def test_empty_and_repeated(spark):
    rules = [U.parse_rule(r) for r in U.RULES]
    assert U.judge_urls(pages(spark, []), rules).count() == 0
    twice = pages(spark, ["http://a.net/es/"]).union(pages(spark, ["http://a.net/es/"]))
    assert [r["verdict"] for r in U.judge_urls(twice, rules).collect()] == ["block", "block"]
    assert {r["verdict"] for r in U.judge_urls(twice, []).collect()} == {"allow"}


def test_null_ids_and_rules_of_equal_length(spark, monkeypatch):
    frame = spark.createDataFrame([(None, "http://a.bc/d"), (None, None), (1, "http://x.a.bc/d")], "page_id long, url string")
    rules = [U.Rule("allow", "bc", "/d" + "*"), U.Rule("block", "a.bc", "/"), U.Rule("allow", "a.bc", "/")]
    for cells in (4_000_000, 1):  # one URL at a time gives the same
        monkeypatch.setattr(U, "BATCH_CELLS", cells)
        got = sorted(((r["page_id"], r["host"], r["rule"], r["verdict"]) for r in U.judge_urls(frame, rules).collect()), key=repr)
        # of equal lengths the longer host wins, then the rule given first
        assert got == sorted([(None, "a.bc", "a.bc/", "block"), (None, "", None, "allow"), (1, "x.a.bc", "a.bc/", "block")], key=repr)
