"""URL rules, and the character models against a plain implementation."""

import math
from collections import Counter, defaultdict

from panelloom.llm import urls

KIND = "page_id long, url string"


def test_hosts_paths_and_rules(spark):
    rows = [
        (1, None), (2, "x"), (3, "HTTP://A.COM/x"), (4, "http://a.com"), (5, "http://EXAMPLE.com/en/1?a"), (6, "https://www.example.com/en/?"),
        (7, "a://b.net/es/#"), (8, "http://net/fr/"), (9, "http://xnet/fr/"), (10, "http://a.b.org/É\n"), (11, "://"), (12, "http://q.com?x=/"), (13, "http://m.www.example.com/en/"), (5, "http://EXAMPLE.com/en/1?a"),
    ]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS host", "2 AS judged", "3 AS score")
    out = {r.page_id: (r.host, r.path, r.rule) for r in urls.verdicts(df).collect()}
    assert out == {
        1: ("", "", None), 2: ("", "", None), 3: ("a.com", "/x", "com/"), 4: ("a.com", "", None), 5: ("example.com", "/en/1", "example.com/en/"), 6: ("www.example.com", "/en/", "www.example.com/en/"),
        7: ("b.net", "/es/", "net/es/"), 8: ("net", "/fr/", "net/fr/"), 9: ("xnet", "/fr/", None), 10: ("a.b.org", "/É\n", None), 11: ("", "", None), 12: ("q.com", "", None), 13: ("m.www.example.com", "/en/", "www.example.com/en/"),
    }
    assert urls.verdicts(df).count() == len(rows)
    full = urls.judge(df)
    assert full.columns == [*df.columns, "judged"]
    assert urls.verdicts(df.limit(0)).collect() == []


def test_scores_match_a_plain_model(spark):
    rows = [("ab.com/x1", "allow"), ("abab.com/x", "allow"), ("z.net/es/qq", "block"), ("zz.net/fr/q", "block"), ("ab.net/q", None)]
    df = spark.createDataFrame(rows * 2, "address string, verdict string")
    got = {r.address: (r.score, r.learned) for r in urls.score_addresses(df).collect()}

    def fold(a):
        return "^" * urls.ORDER + "".join("0" if c.isdigit() else c if c.islower() or c in urls.MARKS else "*" for c in a.lower()) + "$"

    counts = {v: defaultdict(Counter) for v in ("allow", "block")}
    for a, v in rows * 2:
        if v and got[a][1]:
            text = fold(a)
            for i in range(urls.ORDER, len(text)):
                for k in range(urls.ORDER + 1):
                    counts[v][text[i - k : i]][text[i]] += 1

    def probability(v, context, sign):
        lower = probability(v, context[1:], sign) if context else 1 / urls.SIGNS
        seen = counts[v][context]
        return (seen[sign] + len(seen) * lower) / (sum(seen.values()) + len(seen)) if seen else lower

    for a, _ in rows:
        text = fold(a)
        each = [math.log(probability("allow", text[i - urls.ORDER : i], text[i]) / probability("block", text[i - urls.ORDER : i], text[i])) for i in range(urls.ORDER, len(text))]
        assert abs(got[a][0] - sum(each) / len(each)) < 1e-5


def test_model_separates_unruled_urls(spark):
    good = [(k, f"http://site{k}.com/news/{k}") for k in range(60)]
    bad = [(100 + k, f"http://zqx{k}.net/es/zqx/{k}") for k in range(60)]
    df = spark.createDataFrame(good + bad + [(300, "http://site5.org/news/7"), (301, "http://zqx7.org/zqx/zqx")], KIND)
    out = {r.page_id: r.verdict for r in urls.verdicts(df).collect()}
    assert out[300] == "allow" and out[301] == "block"


def test_without_labels_all_is_allowed(spark):
    df = spark.createDataFrame([(1, "http://a.org/"), (2, None)], KIND)
    assert {r.verdict for r in urls.verdicts(df).collect()} == {"allow"}
