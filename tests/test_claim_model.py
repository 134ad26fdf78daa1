"""E-06: what is computed from a fitted model's scores, against SQL over the same scores and all pairs."""

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearth.plans import model_claims as M
from hearth.plans.model import Warehouse

SMOKE = "/root/testdata/sf0.001"
SCORES = "PolicyID string, fold string, has_claim long, claim_probability double"
DECILES = """SELECT CAST((place - 1) * 10 // n + 1 AS BIGINT) AS decile, count(*) AS policies, CAST(sum(has_claim) AS BIGINT) AS with_claim,
  avg(claim_probability) AS mean_probability, min(claim_probability) AS least, max(claim_probability) AS greatest
FROM (SELECT *, row_number() OVER (ORDER BY claim_probability, PolicyID) AS place, count(*) OVER () AS n FROM scores WHERE fold = 'test')
GROUP BY 1 ORDER BY 1"""


def pair_auc(rows):
    pos = [p for h, p in rows if h]
    neg = [p for h, p in rows if not h]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else None


def check(scores):
    rows = [tuple(r) for r in scores.collect()]
    for r in M.evaluation(scores).collect():
        mine = [(h, p) for _, f, h, p in rows if f == r["fold"]]
        assert r["policies"] == len(mine) and r["with_claim"] == sum(h for h, _ in mine)
        want = pair_auc(mine)
        assert r["auc"] == (pytest.approx(want, abs=1e-12) if want is not None else None)
        if mine:
            assert r["brier"] == pytest.approx(sum((h - p) ** 2 for h, p in mine) / len(mine), abs=1e-12)
    con = duckdb.connect()
    con.register("scores", scores.toPandas())
    want = con.sql(DECILES).fetchall()
    got = sorted(tuple(r) for r in M.deciles(scores).collect())
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == pytest.approx(w, abs=1e-12)


def test_trees_on_the_smoke_tables(spark):
    wh = Warehouse(spark, SMOKE)
    scores = M.tree_scores(wh, rounds=5, depth=3)
    check(scores)
    assert scores.count() == wh.silver("policy").count() == scores.select("PolicyID").distinct().count()
    folds = {r[0]: r[1] for r in scores.groupBy("fold").count().collect()}
    assert 0.15 < folds["test"] / sum(folds.values()) < 0.35


def test_held_out_labels_do_not_reach_the_fit(spark, monkeypatch):
    """Turning every held-out label round leaves all scores as they were."""
    features = M.tree_features(Warehouse(spark, SMOKE)).limit(400)
    rows = spark.createDataFrame(features.orderBy("PolicyID").collect(), features.schema)
    turned = rows.withColumn("label", F.when(F.col("fold") == M.TEST, 1 - F.col("label")).otherwise(F.col("label")))
    got = []
    for table in (rows, turned):
        monkeypatch.setattr(M, "tree_features", lambda wh, table=table: table)
        got.append({r[0]: r["claim_probability"] for r in M.tree_scores(None, rounds=3, depth=2).collect()})
    assert got[0] == got[1] and len(set(got[0].values())) > 1


@pytest.mark.parametrize("rows", [
    [],                                                                   # no policies
    [("a", "test", 1, 0.5)],                                              # one label, fewer rows than deciles
    [(f"p{i:02d}", "test", i % 3 == 0, 0.25 * (i % 3)) for i in range(25)],   # ties
    [(f"p{i:02d}", "train", 0, 0.1) for i in range(3)] + [("q", "test", 0, 0.1), ("r", "test", 1, 0.1)],
])
def test_small_folds_and_ties(spark, rows):
    check(spark.createDataFrame([(i, f, int(h), p) for i, f, h, p in rows], SCORES))


def test_one_label_or_no_policies_has_no_trees(spark, monkeypatch):
    features = M.tree_features(Warehouse(spark, SMOKE))
    empty = spark.createDataFrame([], features.schema)
    monkeypatch.setattr(M, "tree_features", lambda wh: empty)
    assert M.tree_scores(None).collect() == []
    same = spark.createDataFrame(features.limit(20).collect(), features.schema).withColumn("label", F.lit(1.0))
    monkeypatch.setattr(M, "tree_features", lambda wh: same)
    assert {r["claim_probability"] for r in M.tree_scores(None).collect()} == {1.0}


def test_many_categories(spark, monkeypatch):
    """More categories than the usual bins: every one gets its own."""
    features = M.tree_features(Warehouse(spark, SMOKE)).limit(300)
    table = spark.createDataFrame(features.collect(), features.schema).withColumn("Region", F.concat(F.lit("r"), F.pmod(F.hash("PolicyID"), F.lit(90)).cast("string")))
    monkeypatch.setattr(M, "tree_features", lambda wh: table)
    assert M.tree_scores(None, rounds=2, depth=2).count() == 300


def test_fewer_rows_than_categories_have_no_trees(spark, monkeypatch):
    """A fold whose every row has a category of its own: the share is the score; one row more, and there are trees."""
    features = M.tree_features(Warehouse(spark, SMOKE)).limit(6)
    rows = spark.createDataFrame(features.collect(), features.schema)
    table = rows.select("PolicyID", F.lit("train").alias("fold"), (F.row_number().over(Window.orderBy("PolicyID")) % 2).cast("double").alias("label"),
                        *[F.col("PolicyID").alias(c) if c == "Region" else F.lit("x").alias(c) for c in M.CATEGORIES], *M.NUMBERS)
    monkeypatch.setattr(M, "tree_features", lambda wh: table)
    assert {r["claim_probability"] for r in M.tree_scores(None, rounds=1, depth=1).collect()} == {0.5}
    one_more = table.unionByName(table.limit(1))
    monkeypatch.setattr(M, "tree_features", lambda wh: one_more)
    assert M.tree_scores(None, rounds=1, depth=1).count() == 7
