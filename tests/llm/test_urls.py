from tallyhouse.llm.urls import RULES, Rule, build, judge, parts, terms_in

URLS = [
    (0, "http://WWW.Foo.ORG/a?b=c#d"), (1, "https://foo.org"), (2, "https://m.example.org/es/1"), (3, "https://example.org/en/12"), (4, "https://badexample.org/es/1"),
    (5, "https://x.com/fr/casino"), (6, "https://x.com/de/a"), (7, "https://com/de/a"), (8, "https://x.net/Casino777"), (9, "https://essex.net/adulthood"), (10, "https://cheap.net/free"),
    (11, "https://cheap.net/cheap-cheap"), (12, None), (13, ""), (14, "casino.net/x"), (15, "://"), (16, "http://x.net?casino"), (17, "http://x.net#/casino"), (18, "a://b://casino.net/x"),
    (18, "a://b://casino.net/x"), (None, "http://free-bets.net/"), (19, "http://x.net/" + "a/" * 100_000 + "porn"), (20, "http://x.org:80/casino"), (21, "http://é.net/é-xxx-é"),
]


def test_hosts_paths_rules_and_terms(spark):
    rows = [(p, u, "h", 1.0) for p, u in URLS]
    got = {(r.page_id, r.host, r.path[:20], r.rule, r.verdict) for r in judge(spark.createDataFrame(rows, "page_id long, url string, host string, weight double")).collect()}
    assert got == {
        (0, "www.foo.org", "/a", "org/", "allow"), (1, "foo.org", "", None, "allow"), (2, "m.example.org", "/es/1", "example.org/es/", "block"),
        (3, "example.org", "/en/12", "example.org/en/1", "block"), (4, "badexample.org", "/es/1", "org/", "allow"), (5, "x.com", "/fr/casino", "com/fr/", "allow"),
        (6, "x.com", "/de/a", "com/de/", "block"), (7, "com", "/de/a", "com/de/", "block"), (8, "x.net", "/Casino777", None, "block"), (9, "essex.net", "/adulthood", None, "allow"),
        (10, "cheap.net", "/free", None, "block"), (11, "cheap.net", "/cheap-cheap", None, "allow"), (12, "", "", None, "allow"), (13, "", "", None, "allow"), (14, "", "", None, "allow"),
        (15, "", "", None, "allow"), (16, "x.net", "", None, "allow"), (17, "x.net", "", None, "allow"), (18, "b:", "//casino.net/x", None, "block"), (None, "free-bets.net", "/", None, "block"),
        (19, "x.net", "/a/a/a/a/a/a/a/a/a/a", None, "block"), (20, "x.org:80", "/casino", None, "block"), (21, "é.net", "/é-xxx-é", None, "block"),
    }


def test_other_vocabularies_ties_and_an_empty_table(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
    pages = spark.createDataFrame([(1, "http://a.b.c/d"), (2, "http://a.b.c/x")], "page_id long, url string")
    rules = [Rule("allow", "c", "/d"), Rule("block", "b.c", "/"), *RULES]
    got = {r.page_id: r for r in judge(pages, {}, rules).collect()}
    assert got[1].rule == got[2].rule == "b.c/" and got[1].strict == []
    rows = judge(pages, {"X": 5, "b": 1, "": 9}, [], threshold=3).collect()
    assert {r.page_id: (r.strict, r.soft, r.weight, r.verdict) for r in rows} == {1: ([], ["b"], 1, "allow"), 2: (["x"], ["b"], 6, "block")}


def test_bounds_of_overlapping_terms():
    automaton = build({"free": 1, "freebet": 2, "bet": 1})
    assert terms_in(automaton, "freebet") == {"freebet"} and terms_in(automaton, "free.bet-FREEBET") == {"free", "bet", "freebet"}
    assert terms_in(automaton, "xfree free") == {"free"} and parts("x://") == ("", "")
