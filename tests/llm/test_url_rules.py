import itertools
import re
import time
from random import Random

import pytest
from corpus_helpers import table
from pyspark.sql import functions as F

from tidemark.llm import queries, url_rules

RULES = url_rules.GIVEN_RULES


def parsed(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]


def given(host, path):
    fits = []
    for verdict, rule in RULES:
        suffix, _, rest = rule.partition("/")
        if (host == suffix or host.endswith("." + suffix)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://ORG/", "http://org", "https://a.ORG/x?y#z", "http://example.org/es/1",
    "http://www.example.org/en/1", "http://example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/",
    "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/DE/1", "http://com/de/?a://b.org/", "x://y://z.org/a", "://a.org/b",
    "http://a.net?q=1&r=2", "http://b.net#f/org/", "http://ÄB.com/de/\nx", "http://c.com" + "/seg" * 5000, "http://a.org/\n/b",
]


def test_odd_urls(spark, no_labels):
    rows = [*enumerate(URLS), (3, "http://"), (None, "http://x.com/de/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("tokens", F.lit("!"))
    found = url_rules.judge(pages, no_labels).collect()
    assert len(found) == len(rows)
    for r in found:
        url = "http://x.com/de/" if r["page_id"] is None else URLS[r["page_id"]]
        assert (r["host"], r["path"]) == parsed(url)
        rule, verdict = given(*parsed(url))
        assert (r["rule"], r["verdict"]) == (rule, verdict or "allow")
    assert url_rules.judge(pages.limit(0), no_labels).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("https://Blog.a.org/en/12-x/?p=1&q#t",), (None,)], "url string")
    got = [r[0] for r in df.select(url_rules.tokens(F.col("url"))).collect()]
    assert got == [["h:a", "h:blog", "h:org", "p:0-x", "p:en", "q:p", "q:q"], []]


def test_mined_rules_block_the_rest(spark):
    spam = [(i, f"http://www.spam{i % 2}.net/offers/{i}?win={i}") for i in range(60)]
    fine = [(100 + i, f"http://www.fine{i % 3}.net/{'offers' if i % 4 else 'news'}/{i}") for i in range(120)]
    pages = spark.createDataFrame([*spam, *fine, (900, "http://new.net/offers/7?win=1"), (901, "http://new.net/offers/7")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0) for i, _ in spam] + [(i, 1) for i, _ in fine], "doc_id long, quality int")
    got = {r["page_id"]: r for r in url_rules.judge(pages, labels).collect()}
    assert all(got[i]["verdict"] == "block" for i, _ in spam) and all(got[i]["verdict"] == "allow" for i, _ in fine)
    assert got[900]["verdict"] == "block" and got[900]["mined_rule"] == "q:win" and got[901]["verdict"] == "allow"
    assert got[0]["confidence"] == 1.0


def test_matching_equals_brute_force(spark):
    rules = [(["a", "b"], "a", 0.9), (["c"], "c", 0.6), (["a", "d"], "d", 0.7)]
    index = spark.createDataFrame(rules, "rule_tokens array<string>, anchor string, confidence double")
    sets = [["a"], ["a", "b"], ["a", "b", "c"], ["d"], ["a", "d"], []]
    found = url_rules.matches(spark.createDataFrame([(s,) for s in sets], "tokens array<string>"), index)
    got = {tuple(r["tokens"]): r["confidence"] for r in found.collect()}
    assert got == {("a", "b"): 0.9, ("a", "b", "c"): 0.9, ("a", "d"): 0.7}
    assert all(max((c for t, _, c in rules if set(t) <= set(s)), default=None) == got.get(tuple(s)) for s in sets)


def test_query(spark, sf_dir):
    urls = {r["page_id"]: r["url"] for r in table(spark, sf_dir, "pages").collect()}
    found = queries.queries()["op10_url_rules"](spark, sf_dir).collect()
    assert sorted(r["page_id"] for r in found) == sorted(urls)
    for r in found:
        host, path = parsed(urls[r["page_id"]])
        rule, verdict = given(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["mined_rule"] else "allow"))


def brute_rules(rows, need, confidence):
    """Every token combination with enough bad rows and confidence, by its confidence."""
    counts = {}
    for tokens, bad in rows:
        for k in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), k):
                n, m = counts.get(part, (0, 0))
                counts[part] = n + 1, m + bad
    return {part: m / n for part, (n, m) in counts.items() if m >= need and m / n >= confidence}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mined_rules_equal_brute_force(spark, seed):
    random = Random(seed)
    rows = []
    for _ in range(60):
        tokens = {t for t in "abcdef" if random.random() < 0.4}
        if "a" in tokens:
            tokens.add("z")  # always together
        bad = random.random() < (0.9 if {"b", "c"} <= tokens else 0.3)
        rows.append((sorted(tokens), bad))
    rows += [(["s", "t"], True)] * 6
    rows = [r for r in rows if r[0]]
    brute = brute_rules(rows, 3, 0.6)
    mined = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.001, 3, 0.6)
    kept = {tuple(r["rule_tokens"]): r for r in mined[0].collect()}
    minimal = {p: c for p, c in brute.items() if not any(set(q) < set(p) and brute[q] >= c for q in brute)}
    item = {r["token"]: r["item"] for r in mined[1].collect()}
    assert item["a"] == item["z"] and item["s"] == item["t"]
    by_items = {tuple(sorted({item[t] for t in p})): c for p, c in minimal.items()}
    assert {p: r["confidence"] for p, r in kept.items()} == by_items
    assert any(len(p) > 1 for p in kept)
    asked = [sorted(t for t in "abcdefstz" if random.random() < 0.4) for _ in range(40)] + [["z"], ["a"], []]
    found = url_rules.fired(spark.createDataFrame([(a,) for a in asked], "tokens array<string>").distinct(), mined)
    got = {tuple(r["tokens"]): r for r in found.collect()}
    for a in asked:
        sure = max((c for p, c in brute.items() if set(p) <= set(a)), default=None)
        assert (got[tuple(a)]["confidence"] if tuple(a) in got else None) == sure
        assert sure is None or set(got[tuple(a)]["rule_tokens"]) <= set(a)


def test_urls_of_many_tokens_and_repeated_labels(spark):
    """Neither one page of 200 segments, nor a template with segments that come and go, multiplies the work."""
    one = [(0, "http://a.org/" + "/".join(f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)))]
    some = [(i, f"http://b{i}.org/x") for i in range(1, 11)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(11) for _ in range(1 + 9 * (i == 0))], "doc_id long, quality int")
    pages = spark.createDataFrame([*one, *some], "page_id long, url string")
    got = {r["page_id"]: r["mined_rule"] for r in url_rules.judge(pages, labels).collect()}
    assert len(got) == 11 and not any("p:s" in (rule or "") for rule in got.values())
    # Segments k and up of 200, so that no two of them stand in the same pages.
    names = [f"p:{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    chain = [(["all", *names[i % 200 :]], i % 3 > 0) for i in range(3000)]
    start = time.monotonic()
    rules, _ = url_rules.mine(spark.createDataFrame(chain, "tokens array<string>, bad boolean"))
    assert rules.count() and time.monotonic() - start < 120


@pytest.mark.parametrize("seed", [1, 2])
def test_long_baskets_are_mined_whole(spark, seed):
    """The rules are those of brute force at any bound of the baskets for FP-growth."""
    random = Random(seed)
    sets = [{t for t in "abcdefg" if random.random() < 0.6} for _ in range(70)]
    rows = [(sorted(s), random.random() < (0.9 if "efg" <= "".join(sorted(s & set("efg"))) else 0.4)) for s in sets if s]
    brute = brute_rules(rows, 3, 0.5)
    minimal = {p: c for p, c in brute.items() if not any(set(q) < set(p) and brute[q] >= c for q in brute)}
    assert max(map(len, minimal)) > 2
    labelled = spark.createDataFrame(rows, "tokens array<string>, bad boolean")
    for max_items in (1, 3, 10):
        rules, members = url_rules.mine(labelled, 0.001, 3, 0.5, max_items)
        assert all(r["token"] == r["item"] for r in members.collect())
        assert {tuple(r["rule_tokens"]): r["confidence"] for r in rules.collect()} == minimal


def test_a_rule_beyond_the_ten_surest_items_of_a_page(spark):
    """Two items that say little alone and all together, beside twelve that say more alone."""
    loud = [f"l{i:02}" for i in range(12)]
    rows = [([*loud[:i], *loud[i + 1 :], "y", "z"], True) for i in range(12)] + [([x], False) for x in loud]
    rows += [([x], False) for x in "yz" for _ in range(20)]
    rules, _ = url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))
    found = {tuple(r["rule_tokens"]): (r["confidence"], r["rows"]) for r in rules.collect()}
    assert found["y", "z"] == (1.0, 12) and found["l00", "l01"] == (1.0, 10)
    wide = spark.createDataFrame([(["new", "y", "z"],), (["new", "y"],)], "tokens array<string>")
    assert [r["tokens"] for r in url_rules.fired(wide, url_rules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"))).collect()] == [["new", "y", "z"]]
