from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from millrace.llm import url_trees as U
from millrace.llm.workload import RULES


def judged(spark, urls, model=None):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    model = model or U.UrlModel(U.feature_names(), [], 0.0, [], {}, 0.0)
    return [r for r in U.judge(df, "url", RULES, model).orderBy("page_id").collect()]


def test_hosts_paths_and_rules(spark):
    rows = judged(spark, [
        "https://WWW.Example.com/en/1?x=1", "http://a.example.com/en/", "http://example.com/fr/", "http://notexample.com/en/x",
        "http://x.net/es/2#top", "http://net/fr/", "http://x.net/en/", "http://example.com?q=://b.net/es/", None, "no scheme", "",
        "ftp://É.com/a://b", "http://com.org/"])
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("a.example.com", "/en/", "example.com/en/", "block"),
        ("example.com", "/fr/", "com/", "allow"), ("notexample.com", "/en/x", "com/", "allow"),
        ("x.net", "/es/2", "net/es/", "block"), ("net", "/fr/", "net/fr/", "block"), ("x.net", "/en/", None, "allow"),
        ("example.com", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("É.com", "/a://b", "com/", "allow"), ("com.org", "/", None, "allow")]


def test_features(spark):
    url = F.lit("https://www.a-b.example.com/x/y1.html?p=1&q=%20#t")
    row = spark.range(1).select(*[c.alias(n) for n, c in U.lexical_features(url).items()]).first().asDict()
    assert {k: row[k] for k in ("depth", "labels", "hyphens", "parameters", "escapes", "fragment", "secure", "www", "extension")} == {
        "depth": 2, "labels": 3, "hyphens": 1, "parameters": 2, "escapes": 1, "fragment": 1, "secure": 1, "www": 1, "extension": 1}
    assert row["size"] == 49 and 3 < row["entropy"] < 5


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


def test_held_out_urls_are_judged_as_the_rules_judge_them(spark):
    """Learned from part of the URLs that rules decide, right on the others."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    every = U.labelled_by_rules(pages, "url", RULES).withColumn("held", F.crc32(F.col("url").cast("binary")) % 3 == 0)
    model = U.train(every.where("not held"), "url", "blocked", U.Boosting(trees=6))
    scored = U.judge(every.where("held"), "url", [], model)
    right = scored.agg(F.avg(((F.col("score") >= 0.5) == F.col("blocked")).cast("int"))).first()[0]
    assert len(model.trees) == 6 and right > 0.9


def test_urls_of_hosts_never_seen(spark):
    """Trained on some hosts, tested on the others: what a host alone tells must not count."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    host = F.xxhash64(U.host_of(F.col("url"))) % 3 == 0
    every = U.labelled_by_rules(pages, "url", RULES).withColumn("held", host)
    model = U.train(every.where("not held"), "url", "blocked", U.Boosting(trees=6))
    scored = U.judge(every.where("held"), "url", [], model)
    right, most = scored.agg(F.avg(((F.col("score") >= 0.5) == F.col("blocked")).cast("int")),
                             F.greatest(F.avg(F.col("blocked").cast("int")), 1 - F.avg(F.col("blocked").cast("int")))).first()
    assert right > 0.9 and right >= most


def test_a_label_does_not_enter_its_own_features(spark):
    """A host with one label only says nothing about itself while the trees are trained."""
    rows = [(f"http://h{i}.site{i}.net/p", i % 2 == 0) for i in range(200)]
    model = U.train(spark.createDataFrame(rows, "url string, blocked boolean"), "url", "blocked", U.Boosting(trees=3))
    scored = U.judge(spark.createDataFrame(rows, "url string, blocked boolean"), "url", [], model)
    assert scored.agg(F.avg(((F.col("score") >= 0.5) == F.col("blocked")).cast("int"))).first()[0] < 0.8


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, pages):
    labelled = U.labelled_by_rules(pages, "url", RULES)
    one, two = (U.train(labelled.repartition(n, *by), "url", "blocked", U.Boosting(trees=3)) for n, by in ((1, []), (7, ["url"])))
    assert one.cuts == two.cuts and one.trees == two.trees


def test_scores_agree_with_plain_python(spark, pages):
    labelled = U.labelled_by_rules(pages, "url", RULES)
    model = U.train(labelled, "url", "blocked", U.Boosting(trees=3))
    tables = {n: {(r.suffix, r.fold): (r.n, r.blocked) for r in t.collect()} for n, t in model.counts.items()}
    made = pages.select("page_id", "url", U._fold(F.col("url")).alias("fold"), *[c.alias(n) for n, c in {**U.lexical_features(F.col("url")), **U.parts(F.col("url"))}.items()])
    scores = {r.page_id: r.score for r in U.judge(pages.select("page_id", "url"), "url", [], model).collect()}
    for row in made.collect():
        values = row.asDict()
        for part in U.PARTS:
            (n, b), own = (tables[part].get((values[part], fold), (0, 0)) for fold in (None, row.fold))
            n, b = n - own[0], b - own[1]
            values[f"{part}_count"], values[f"{part}_blocked"] = n, (b + 20 * model.share) / (n + 20)
        margin = model.base
        for tree in model.trees:
            node = 1
            while node in tree.splits:
                feature, highest = tree.splits[node]
                value = round(math.log1p(values[model.names[feature]]) + 1e-13, 3)
                node = 2 * node + (sum(value > e for e in model.cuts[feature]) > highest)
            margin += tree.values.get(node, 0.0)
        assert abs(scores[row.page_id] - 1 / (1 + math.exp(-margin))) < 1e-9


def test_odd_urls_and_names(spark, pages):
    """Very long URLs, nulls, and columns named like those used inside."""
    model = U.train(U.labelled_by_rules(pages, "url", RULES), "url", "blocked", U.Boosting(trees=2))
    long_url = "http://" + "a." * 2_000 + "net/" + "x/" * 20_000 + "?" + "k=v&" * 5_000
    names = ["bins", "link", "rest", "fold", "size", "suffix1_n", "__url", "margin"]
    df = spark.createDataFrame([(u, *range(len(names))) for u in (long_url, None, "", "http://x.net/es/1", long_url)],
                               "url string, " + ", ".join(f"{n} int" for n in names))
    rows = U.judge(df, "url", RULES, model).collect()
    assert len(rows) == 5 and all(tuple(r)[1:9] == tuple(range(8)) and 0 <= r.score <= 1 for r in rows)
    trained = U.train(df.withColumn("label", F.col("bins") > 0).limit(0), "url", "label")
    assert not trained.trees


def test_no_python_runs(spark, pages):
    model = U.UrlModel(U.feature_names(), [], 0.0, [], {}, 0.0)
    plan = U.judge(pages, "url", RULES, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_kind_of_label_or_none(spark, pages):
    for labels, share in ((pages.limit(0).withColumn("blocked", F.lit(True)), 0.0), (pages.withColumn("blocked", F.lit(True)), 1.0)):
        model = U.train(labels, "url", "blocked")
        assert model.share == share and not model.trees
    clash = pages.limit(3).withColumn("verdict", F.lit("mine"))
    assert U.judge(clash, "url", RULES, model).columns == ["page_id", "url", "html", *U.RESULTS]
