import re

from hearth.llm import url_filter as uf
from hearth.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, host string, canonical string, block int, hit boolean"
URLS = ["http://example.com/en/1", "HTTPS://WWW.Example.com/en/1.html?x=1", "https://www.example.com/en/1#top", "http://sub.www.example.com/en/",
        "http://example.com", "http://example.com?x=/en/", "http://a.net/es/", "http://net/fr/x", "http://xnet/fr/x", "http://a.net/en/5/", "http://a.net/en/5",
        "http://ÄB.org/é", "no scheme/en/", "", None, "a://b://c/d", "http:///path", "http://a.org/" + "x" * 20000, "http://a.net/en/6", "http://example.com/de/"]


def rows():
    return [(i, u, "h", "x", "y", 1, True) for i, u in enumerate(URLS + URLS[9:11])]


def brute(pages, listed):
    out = []
    for i, u, *_ in pages:
        host = path = ""
        canonical = None
        if u is not None and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.split(r"[/?#]", rest, maxsplit=1)[0]
            path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
            canonical = host.removeprefix("www.") + path.rstrip("/").removesuffix(".html")
        fits = [(len(h + p), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, None)
        hit = canonical is not None and canonical in listed
        out.append((i, host, path, rule, verdict or ("block" if hit else "allow"), hit))
    return sorted(out, key=str)


def judged(spark, pages, listed, **options):
    names = spark.createDataFrame([(c, 1) for c in listed], "canonical string, page_id int")
    got = uf.url_verdicts(spark.createDataFrame(pages, SCHEMA), names, URL_RULES, **options).collect()
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.listed) for r in got), key=str)


def test_matches_brute_force(spark):
    listed = ["a.net/en/5", "a.net/en/5", None, "nowhere.org/x", "ÄB.org/é"]
    assert judged(spark, rows(), listed) == brute(rows(), set(listed) - {None})


def test_empty_list_and_table(spark):
    assert judged(spark, rows(), []) == brute(rows(), set())
    assert judged(spark, [], ["a.net/en/5"]) == []


def test_filter_passes_every_listed_key_and_few_others(spark):
    from pyspark.sql import functions as F
    listed = spark.range(5000).select(F.concat(F.lit("a.org/"), F.col("id").cast("string")).alias("k"))
    asked = spark.range(20000).select(F.concat(F.lit("a.org/"), F.col("id").cast("string")).alias("k"))
    for limit in (1 << 25, 0):          # broadcast, and joined by shuffle
        hits = uf.listed_hits(asked, listed, "k", broadcast_bytes=limit)
        assert hits.count() == 5000 and hits.join(listed, "k", "left_anti").count() == 0


def test_shared_addresses(spark):
    got = {r.canonical for r in uf.shared_addresses(spark.createDataFrame(rows(), SCHEMA)).collect()}
    assert got == {"example.com", "example.com/en/1", "a.net/en/5"}


def test_every_way_of_joining_agrees(spark):
    """Filter and list broadcast, only the filter broadcast, neither: the same verdicts, a hot url and false positives among them."""
    pages = [(100 + i, f"http://a.net/en/{i % 70}", "h", "x", "y", 1, True) for i in range(300)] + rows() * 3
    pages += [(900 + i, "http://hot.org/a", "h", "x", "y", 1, True) for i in range(200)]
    listed = [f"a.net/en/{i}" for i in range(0, 70, 2)] + ["hot.org/a", "x" * 3000, None]
    filter_size = uf.filter_bytes(uf.filter_blocks_for(len(listed) - 1))
    want = brute(pages, set(listed) - {None})
    for limit in (1 << 25, filter_size, 0):
        assert judged(spark, pages, listed, broadcast_bytes=limit) == want


def test_pages_that_the_filter_stops_are_not_exchanged(spark, capsys):
    pages = spark.createDataFrame(rows(), SCHEMA)
    names = spark.createDataFrame([("a.net/en/5",)], "canonical string")
    uf.url_verdicts(pages, names, URL_RULES).explain("simple")
    assert "hashpartitioning" not in capsys.readouterr().out
    size = uf.filter_bytes(uf.filter_blocks_for(1))     # room for the filter, not for the list
    long = spark.createDataFrame([("a.net/" + "x" * 200,)], "canonical string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        uf.url_verdicts(pages, long, URL_RULES, broadcast_bytes=size).explain("simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    possible, stopped = re.split(r"^   \+- ", plan[plan.index("Union"):], flags=re.M)      # the union's two branches
    assert "hashpartitioning(canonical" in possible and "hashpartitioning" not in stopped and "hit" in stopped
