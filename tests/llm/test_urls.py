"""URL rules against plain string work, and the trees on URLs they have not seen."""

import re

from pyspark.sql import functions as F

from ontime.llm import urls
from ontime.llm.queries import QUERIES, URL_RULES, url_rules

SF = "/root/testdata/sf0.01"
ODD = [None, "", "no scheme", "http://", "://", "HTTP://Example.COM/en/x", "http://www.EXAMPLE.com/en/", "http://a.example.com/en", "http://xexample.com/en/", "http://com", "http://com/", "http://a.net/es/?q=://b.com/", "http://É.net/fr/\n#x", "http://a.net:80/fr/", "x://y.net/fr/z?a=1&b=2", "http://" + "a." * 3000 + "net/es/" + "p" * 100_000]


def plain(url, rules=URL_RULES):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fit = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit, key=lambda r: len(r[0])) if fit else (None, None)))


def test_rules(spark):
    df = spark.createDataFrame([(u,) for u in ODD + ODD], "url string").selectExpr("*", "'x' AS host", "2 AS Rule")
    out = urls.with_rules(df, url_rules(spark))
    assert out.columns == ["url", "host", "Rule", "host_", "path", "rule_", "verdict"]
    got = out.collect()
    assert len(got) == 2 * len(ODD)
    for r in got:
        assert (r["host_"], r["path"], r["rule_"], r["verdict"]) == plain(r.url)
    assert urls.with_rules(df.limit(0), url_rules(spark)).count() == 0


def test_query_on_the_test_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op9_url_trees"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        host, path, rule, verdict = plain(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ({verdict} if verdict else {"allow", "block"})


def test_trees_on_unseen_urls(spark):
    """Labels that follow from lexical traits; half of the URLs are held out."""
    bad = F.col("id") % 2 == 0
    digits = F.repeat(F.col("id").cast("string"), 6)
    url = F.concat(F.lit("http://"), F.when(bad, F.concat(F.lit("x-"), digits)).otherwise("news"), F.lit(".site.org/a/"), F.col("id").cast("string"))
    df = spark.range(4000).select("id", url.alias("url"), F.when(bad, "block").otherwise("allow").alias("truth"))
    model = urls.fit(df.where("id < 2000"), verdict="truth", max_rows=1000)
    held = urls.judge(df.where("id >= 2000").withColumn("verdict", F.lit(None).cast("string")), model)
    assert held.columns == ["id", "url", "truth", "verdict"]
    assert held.where("truth = verdict").count() / held.count() > 0.98


def test_odd_urls_are_judged(spark):
    ruled = urls.with_rules(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url"), url_rules(spark))
    model = urls.fit(ruled)
    df = urls.with_rules(spark.createDataFrame([(u,) for u in ODD], "url string"), url_rules(spark))
    got = urls.judge(df, model).collect()
    assert len(got) == len(ODD) and {r.verdict for r in got} <= {"allow", "block"}


def test_one_or_no_label(spark):
    df = spark.createDataFrame([("http://a.org", None), (None, "block"), ("http://b.org", "block")], "url string, verdict string")
    assert [r.verdict for r in urls.judge(df, urls.fit(df)).collect()] == ["block"] * 3
    none = df.withColumn("verdict", F.lit(None).cast("string"))
    assert [r.verdict for r in urls.judge(none, urls.fit(none)).collect()] == ["allow"] * 3


def test_rows_are_not_shuffled_by_host(spark):
    """One host may hold most rows; the rules of few hosts go to the rows."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    plan = urls.with_rules(pages, url_rules(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op9_url_trees"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
