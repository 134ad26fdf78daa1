"""E-06 claim probability models with pyspark.ml.

Features are built at the policy grain by the same star code as the
reports (no fan-out); the label is "the policy has at least one claim".
Training is distributed (L-BFGS over partitions); the fitted model scores
every policy.  The feature frame is checkpointed once, so the several passes
of the fit do not re-derive it.

``claim_probability`` is a logistic regression over all policies.
``tree_scores`` fits gradient-boosted trees on one fold of the policies (by a
hash of the PolicyID) and scores both; ``evaluation`` and ``deciles`` judge the
scores of each fold.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.operators.keys import assign_key
from hearth.plans import star
from hearth.sources.files import staged

TRAIN, TEST = "train", "test"
CATEGORIES = ("PropertyType", "PropertyAgeBand", "Channel", "Region", "ProductType", "PaymentPlan")
NUMBERS = ("net_premium", "instalments", "risk_score", "prior_claims", "has_alarm", "bedrooms", "rebuild_cost",
           "commission", "inception_year", "inception_month", "term_days")
FOLDS = 4                        # one policy in FOLDS is held out


def policy_features(wh) -> DataFrame:
    g = star.policy_grain(wh).filter(F.col("is_policy") == 1)
    a = star.address_dim(wh).select("_dk", "PropertyType", "PropertyAgeBand")
    b = star.broker_dim(wh).select(F.col("_dk").alias("_bk"), "Channel")
    j = (g.join(a, g["AddressID"] == a["_dk"], "left").join(b, g["BrokerID"] == b["_bk"], "left"))
    return j.select(
        "PolicyID",
        F.coalesce(F.col("net").cast("double"), F.lit(0.0)).alias("net_premium"),
        F.coalesce("PropertyType", F.lit("Unknown")).alias("PropertyType"),
        F.coalesce("PropertyAgeBand", F.lit("Unknown")).alias("PropertyAgeBand"),
        F.coalesce("Channel", F.lit("Unknown")).alias("Channel"),
        (F.coalesce("n_claims", F.lit(0)) > 0).cast("double").alias("label"))


def claim_probability(wh, max_iter: int = 20) -> DataFrame:
    # Each ML stage makes its own pass over the input: write the features
    # once to the reliable checkpoint folder and let every pass read them.
    from hearth.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(wh.spark)
    df = policy_features(wh).checkpoint(eager=True)
    cats = ["PropertyType", "PropertyAgeBand", "Channel"]
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep") for c in cats]
    stages.append(OneHotEncoder(inputCols=[f"{c}_ix" for c in cats], outputCols=[f"{c}_oh" for c in cats]))
    stages.append(VectorAssembler(inputCols=["net_premium", *[f"{c}_oh" for c in cats]], outputCol="features"))
    stages.append(LogisticRegression(maxIter=max_iter, regParam=0.01, standardization=True))
    model = Pipeline(stages=stages).fit(df)
    scored = model.transform(df)
    return scored.select("PolicyID", F.col("label").cast("int").alias("has_claim"),
                         vector_to_array("probability")[1].alias("claim_probability"))


def fold(policy_id: Column) -> Column:
    """``test`` for the policies whose MD5 starts with one of the first 16 / FOLDS hex digits, else ``train``."""
    first = F.conv(F.substring(F.md5(policy_id), 1, 1), 16, 10).cast("int")
    return F.when(first < 16 // FOLDS, TEST).otherwise(TRAIN)


def tree_features(wh) -> DataFrame:
    """One row per policy: what is known without its claims, its fold and its label (1 with a claim).

    Missing numbers are -1 and missing categories ``Unknown``, so a tree can
    split on them."""
    pol = wh.silver("policy", columns=("PolicyID", "AddressID", "BrokerID", "ProductType", "PaymentPlan", "InceptionDate", "ExpiryDate"))
    premiums = wh.silver("premium_transactions", columns=("PolicyID", "NetPremium")).groupBy("PolicyID").agg(
        F.sum("NetPremium").cast("double").alias("net_premium"), F.count(F.lit(1)).cast("double").alias("instalments"))
    risk = wh.silver("policy_risk", columns=("PolicyID", "RiskScore", "PriorClaimsCount", "HasAlarmFlag")).groupBy("PolicyID").agg(
        F.max("RiskScore").cast("double").alias("risk_score"), F.max("PriorClaimsCount").cast("double").alias("prior_claims"),
        F.max("HasAlarmFlag").cast("double").alias("has_alarm"))
    claimed = wh.silver("claims", columns=("PolicyID",)).where(F.col("PolicyID").isNotNull()).distinct().withColumn("label", F.lit(1.0))
    a = wh.silver("address").select("AddressID", "PropertyType", "PropertyAgeBand", "Region",
                                    F.col("Bedrooms").cast("double").alias("bedrooms"),
                                    F.col("RebuildCostEstimate").cast("double").alias("rebuild_cost"))
    b = wh.silver("broker").select("BrokerID", "Channel", F.col("CommissionRate").cast("double").alias("commission"))
    rows = (pol.select("PolicyID", "AddressID", "BrokerID", "ProductType", "PaymentPlan",
                       F.year("InceptionDate").cast("double").alias("inception_year"),
                       F.month("InceptionDate").cast("double").alias("inception_month"),
                       F.datediff("ExpiryDate", "InceptionDate").cast("double").alias("term_days"))
               .join(premiums, "PolicyID", "left").join(risk, "PolicyID", "left").join(claimed, "PolicyID", "left")
               .join(a, "AddressID", "left").join(b, "BrokerID", "left"))
    return rows.select("PolicyID", fold(F.col("PolicyID")).alias("fold"), F.coalesce("label", F.lit(0.0)).alias("label"),
                       *[F.coalesce(c, F.lit("Unknown")).alias(c) for c in CATEGORIES],
                       *[F.coalesce(c, F.lit(-1.0)).alias(c) for c in NUMBERS])


def tree_scores(wh, rounds: int = 20, depth: int = 4, seed: int = 7) -> DataFrame:
    """``PolicyID, fold, has_claim, claim_probability``: trees fitted on the training fold, all policies scored.

    The scores are written once, so what is computed from them agrees.  A
    training fold without rows, of one label only, or with fewer rows than a
    category column has values (and one for the unseen) has no trees: its share
    of claims (0 without rows) is the score."""
    df = staged(tree_features(wh), "claim-features")           # every round of the fit reads it
    train = df.where(F.col("fold") == TRAIN)
    share, labels, rows, *values = train.agg(F.avg("label"), F.count_distinct("label"), F.count(F.lit(1)),
                                             *[F.count_distinct(c) for c in CATEGORIES]).first()         # one row
    categories = 1 + max(values)
    if labels < 2 or rows < categories:
        scored = df.withColumn("claim_probability", F.lit(float(share or 0.0)))
    else:
        index = StringIndexer(inputCols=list(CATEGORIES), outputCols=[f"{c}_ix" for c in CATEGORIES], handleInvalid="keep").fit(train)
        bins = max(64, categories)        # a tree needs a bin for every category
        stages = [index, VectorAssembler(inputCols=[*NUMBERS, *[f"{c}_ix" for c in CATEGORIES]], outputCol="features"),
                  GBTClassifier(maxIter=rounds, maxDepth=depth, maxBins=bins, stepSize=0.1, seed=seed, cacheNodeIds=False)]
        scored = (Pipeline(stages=stages).fit(train).transform(df)
                  .withColumn("claim_probability", vector_to_array("probability")[1]))
    return staged(scored.select("PolicyID", "fold", F.col("label").cast("long").alias("has_claim"), "claim_probability"), "claim-scores")


def _ranked(scores: DataFrame, which: str) -> DataFrame:
    """The fold's policies numbered by score (ties by PolicyID), without a global window."""
    return assign_key(scores.where(F.col("fold") == which), ["claim_probability", "PolicyID"], "place")


def evaluation(scores: DataFrame) -> DataFrame:
    """One row per fold: policies, those with a claim, the exact area under the ROC curve (ties count
    half, from mean ranks; null with one label only), the Brier score and that of the fold's own share."""
    out = None
    for which in (TRAIN, TEST):
        ties = _ranked(scores, which).groupBy("claim_probability").agg(
            F.count(F.lit(1)).alias("n"), F.sum("has_claim").alias("pos"), F.min("place").alias("first"))
        p = F.col("claim_probability")
        sums = ties.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("policies"), F.coalesce(F.sum("pos"), F.lit(0)).alias("with_claim"),
            F.sum(F.col("pos") * (F.col("first") + (F.col("n") - 1) / 2)).alias("_ranks"),
            F.sum(F.col("pos") * (1 - p) * (1 - p) + (F.col("n") - F.col("pos")) * p * p).alias("_loss"))
        pos, neg = F.col("with_claim"), F.col("policies") - F.col("with_claim")
        share = F.try_divide(pos.cast("double"), F.col("policies").cast("double"))
        row = sums.select(F.lit(which).alias("fold"), "policies", "with_claim",
                          F.try_divide(F.col("_ranks") - pos * (pos + 1) / 2, (pos * neg).cast("double")).alias("auc"),
                          F.try_divide(F.col("_loss"), F.col("policies").cast("double")).alias("brier"),
                          (share * (1 - share)).alias("brier_of_share"))
        out = row if out is None else out.unionByName(row)
    return out


def deciles(scores: DataFrame, which: str = TEST) -> DataFrame:
    """Calibration: the fold in ten equal parts by score, with expected and seen claims of each."""
    ranked = _ranked(scores, which)
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))                       # one row
    part = F.floor((F.col("place") - 1) * 10 / F.col("_n")) + 1
    return (ranked.crossJoin(F.broadcast(n)).groupBy(part.cast("long").alias("decile"))
                  .agg(F.count(F.lit(1)).alias("policies"), F.sum("has_claim").alias("with_claim"),
                       F.avg("claim_probability").alias("mean_probability"),
                       F.min("claim_probability").alias("least"), F.max("claim_probability").alias("greatest")))
