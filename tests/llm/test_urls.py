from bidlens.llm.urls import LONG_SUFFIXES, RULES, Rule, judge, reputation, with_units

SCHEMA = "page_id long, url string, html string, n string, bad string, site string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "own", "own", "own") for i, u in urls], SCHEMA)


def outcomes(spark, rows=()):
    return spark.createDataFrame(list(rows), "page_id long, bad boolean")


def test_parts_and_rules(spark):
    urls = [
        (1, None, "", "", None, "allow"), (2, "no scheme", "", "", None, "allow"), (3, "", "", "", None, "allow"),
        (4, "http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        (5, "http://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
        (6, "http://example.net", "example.net", "", None, "allow"), (7, "http://net/", "net", "/", "net/", "block"),
        (8, "http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        (9, "x://example.com/de/?http://a.net/", "example.com", "/de/", "example.com/de/", "block"),
        (10, "://b.org/fr/#x", "b.org", "/fr/", "org/fr/", "allow"), (11, "http:///p", "", "/p", None, "allow"),
        (12, "a\nb://h.net?x/y", "h.net", "", None, "allow"), (10, "://b.org/fr/#x", "b.org", "/fr/", "org/fr/", "allow"),
        (None, "http://user@h.net:80/a", "user@h.net:80", "/a", None, "allow"),
    ]
    got = judge(pages(spark, [u[:2] for u in urls]), outcomes(spark)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted([(u[0], *u[2:]) for u in urls], key=key)
    assert judge(pages(spark, []), outcomes(spark)).collect() == []
    plain = judge(pages(spark, [(1, "http://a.net/")]), outcomes(spark), rules=()).collect()
    assert [tuple(r) for r in plain] == [(1, "a.net", "/", None, "allow")]
    longest = judge(pages(spark, [(1, "http://a.net/x")]), outcomes(spark),
                    rules=(*RULES, Rule("a.net", "/", "allow"))).first()
    assert longest.rule == "a.net/"


def test_units(spark):
    hosts = ["u@www.shop.co.uk:8080", "a.b.com", "b.com.", "10.0.0.1:80", "com"]
    rows = {r.host: (r.site, r.domain, r.suffix) for r in with_units(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()}
    assert rows == {"u@www.shop.co.uk:8080": ("www.shop.co.uk", "shop.co.uk", "co.uk"), "a.b.com": ("a.b.com", "b.com", "com"),
                    "b.com.": ("b.com", "b.com", "com"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1", ""), "com": ("com", "com", "com")}


def test_suffixes_of_a_longer_list(spark):
    hosts = ["a.b.com.mx", "x.github.io", "a.b.city.kobe.jp", "a.b.c.kobe.jp", "shop.co.uk", "kobe.jp", "1.2.3.4"]
    given = (*LONG_SUFFIXES, "com.mx", "github.io", "*.kobe.jp", "!city.kobe.jp")
    rows = {r.host: (r.domain, r.suffix) for r in with_units(
        spark.createDataFrame([(h,) for h in hosts], "host string"), given).collect()}
    assert rows == {"a.b.com.mx": ("b.com.mx", "com.mx"), "x.github.io": ("x.github.io", "github.io"),
                    "a.b.city.kobe.jp": ("kobe.jp", "jp"), "a.b.c.kobe.jp": ("b.c.kobe.jp", "c.kobe.jp"),
                    "shop.co.uk": ("shop.co.uk", "co.uk"), "kobe.jp": ("kobe.jp", "jp"), "1.2.3.4": ("1.2.3.4", "")}


def test_sites_under_a_given_suffix_are_strangers(spark):
    urls = [(i, f"http://bad.com.mx/{i}") for i in range(60)] + [(100 + i, f"http://g{i}.com/") for i in range(60)]
    labels = outcomes(spark, [(i, True) for i in range(60)] + [(100 + i, False) for i in range(60)])
    docs = pages(spark, [*urls, (999, "http://new.com.mx/")])
    known = [reputation(docs.selectExpr("page_id", "split(url, '/')[2] as host"), labels, **more).levels["domain"]
             .select("domain").collect() for more in ({}, {"suffixes": (*LONG_SUFFIXES, "com.mx")})]
    assert ("com.mx",) in known[0] and ("com.mx",) not in known[1] and ("bad.com.mx",) in known[1]
    assert judge(docs, labels, suffixes=("com.mx",)).count() == len(urls) + 1


def test_much_bad_evidence_blocks_and_little_does_not(spark):
    urls, labels = [], []

    def add(host, n, bad):
        for i in range(n):
            urls.append((len(urls), f"http://{host}/{i}"))
            labels.append((len(labels), i < bad))

    add("bad.spam.com", 40, 39)
    add("few.other.com", 1, 1)
    for k in range(20):
        add(f"h{k}.good{k}.com", 20, k % 3)
    urls.append((10_000, "http://bad.spam.com/new"))
    urls.append((10_001, "http://new.good1.com/new"))
    verdicts = {r.page_id: r.verdict for r in judge(pages(spark, urls), outcomes(spark, [*labels, (0, None)])).collect()}
    assert verdicts[0] == verdicts[10_000] == "block"
    assert verdicts[40] == verdicts[50] == verdicts[10_001] == "allow"
    hosts = pages(spark, urls).selectExpr("page_id", "split(url, '/')[2] as host")
    known = reputation(hosts, outcomes(spark, labels)).levels["site"]
    one = known.filter("site = 'few.other.com'").first()
    assert one.site_mean < 1 and one.site_bound < one.site_mean
