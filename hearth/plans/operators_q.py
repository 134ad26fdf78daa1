"""Queries that exercise single operators of SURVEY §2.1-§2.6 and the
roadmap extensions of §2.13, each over the supplied tables."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions import clean as C
from hearth.functions import kpi as K
from hearth.operators.buckets import BUCKET, merge_buckets, read_buckets, write_buckets
from hearth.operators.joins import anti
from hearth.operators.keys import assign_key
from hearth.operators.quality import distribution, duplicate_keys
from hearth.operators.scd import scd1_merge, with_unknown
from hearth.operators.windows import with_lag, with_percent_rank
from hearth.plans import star
from hearth.plans.audits import ENTITIES
from hearth.plans.bronze import PREMIUM_OPTIONAL, bronze_premium_transactions
from hearth.plans.gold import dim_coverage_from
from hearth.plans.model import present
from hearth.session import ensure_checkpoint_dir
from hearth.sources.files import align, read_raw, split_malformed, staged, write_table
from hearth.sources.schemas import load_staging, staging_schema

# Fixed weights of the roadmap scores (our inputs; the roadmap names the
# factors but gives no weights).
BROKER_SCORE_WEIGHTS = {"loss_ratio": 0.4, "claims_frequency": 0.3, "policies": 0.1, "high_risk_share": 0.2}
POSTCODE_SCORE_WEIGHTS = {"loss_ratio": 0.6, "claims_frequency": 0.4}
LOOKUP_POLICY = "P7"
TOP_BROKERS = 10


def _two_broker_loads(wh) -> tuple[DataFrame, DataFrame, list[str]]:
    """Yesterday's broker dimension, today's rows, and the tracked columns."""
    s = wh.silver("broker").drop("BronzeLoadDts", "SilverLoadDts", "SourceFile")
    old = s.filter(F.col("Status") == "Active").withColumn(
        "CommissionModel", F.when(F.col("BrokerSizeBand") == "Large", F.lit("Legacy")).otherwise(F.col("CommissionModel")))
    target = assign_key(old, ["BrokerID"], "BrokerKey").withColumn("GoldLoadDts", F.lit(wh.now).cast("timestamp"))
    return target, s, [c for c in s.columns if c != "BrokerID"]


def snk_merge1_buckets(wh) -> DataFrame:
    """SNK-MERGE1 in place: the two loads of ``snk_merge1`` on a dimension in
    key-hash buckets, of which only those with a changed member are written."""
    target, s, tracked = _two_broker_loads(wh)
    path, schema = _scratch(wh, "broker-buckets"), target.schema
    write_buckets(target, path, ["BrokerID"])
    merge_buckets(path, schema, s, "BrokerID", tracked, "BrokerKey", wh.now.replace(day=2))
    merged = read_buckets(wh.spark, path, schema).drop(BUCKET)
    return present(merged.withColumn("UpdatedThisLoad", (F.col("GoldLoadDts") > F.lit(wh.now)).cast("int")))


def snk_merge1(wh) -> DataFrame:
    """SNK-MERGE1: yesterday's broker dimension (active brokers only, large
    brokers still on a 'Legacy' commission model) merged with today's silver:
    large brokers are updated, inactive brokers inserted with keys after the
    current maximum, everything else kept as it was."""
    target, s, tracked = _two_broker_loads(wh)
    merged = scd1_merge(target, s, "BrokerID", tracked, "BrokerKey", wh.now.replace(day=2))
    return present(merged.withColumn("UpdatedThisLoad", (F.col("GoldLoadDts") > F.lit(wh.now)).cast("int")))


def a_dupn(wh) -> DataFrame:
    """A-DUPN: duplicate (PolicyID, CoverageType) pairs in the raw coverage."""
    r = wh.raw("coverage").select(C.blank_to_null("PolicyID").alias("PolicyID"),
                                  C.blank_to_null("CoverageType").alias("CoverageType"))
    return present(duplicate_keys(r.filter(F.col("PolicyID").isNotNull() & F.col("CoverageType").isNotNull()),
                                  ["PolicyID", "CoverageType"]))


def a_dist(wh) -> DataFrame:
    """A-DIST: policy status distribution, most frequent first."""
    d = distribution(wh.raw("policy"), "PolicyStatus")
    return present(d.orderBy(F.col("row_count").desc(), "PolicyStatus"))


def o_topk(wh, k: int = TOP_BROKERS) -> DataFrame:
    """O-TOPK: the k brokers with the highest net premium (TakeOrderedAndProject)."""
    r = star.rollup(wh, "broker", ["Broker"], ["net_premium"])
    return present(r.orderBy(F.col("net_premium").desc(), F.col("Broker")).limit(k))


def w_lag(wh) -> DataFrame:
    """W-LAG: previous month amount recomputed per category next to the supplied one."""
    f = wh.gold.fact_operating_expenses.select("ExpenseCategory", "ExpenseMonth", "ExpenseAmount",
                                               "PreviousMonthAmount")
    f = with_lag(f, ["ExpenseCategory"], ["ExpenseMonth"], "ExpenseAmount", 1, "PreviousMonthRecomputed")
    return present(f.withColumn("Agrees", F.col("PreviousMonthRecomputed").eqNullSafe(F.col("PreviousMonthAmount"))
                                .cast("int")))


def w_latestsnap(wh) -> DataFrame:
    """W-LATESTSNAP: supplied LatestSnapshotFlag against the recomputed one."""
    by_flag = lambda df, n: df.groupBy(F.col("LatestSnapshotFlag").alias(f"_{n}")).agg(F.count(F.lit(1)).alias(n))
    every, newest = by_flag(wh.silver("claim_reserves"), "every"), by_flag(star.latest_reserves(wh), "newest")
    j = every.join(F.broadcast(newest), F.expr("_every <=> _newest"), "left")       # one row per flag value
    rows = j.select(F.col("_every").alias("LatestSnapshotFlag"), F.expr("stack(2, 1, coalesce(newest, 0L), 0, every - coalesce(newest, 0L))")
                    .alias("IsLatest", "reserves"))
    return present(rows.filter(F.col("reserves") > 0))


def p_26(wh, policy_id: str = LOOKUP_POLICY) -> DataFrame:
    """P-26: one business key, equality filter (staging policy_risk)."""
    return present(wh.raw("policy_risk").filter(F.col("PolicyID") == policy_id))


def _minmax(df: DataFrame, weights: dict) -> DataFrame:
    """Weighted sum of min-max normalised factors.  The minima and maxima are
    one aggregate row (broadcast), so no global window or single task."""
    mm = df.agg(*[F.min(c).cast("double").alias(f"_lo_{c}") for c in weights],
                *[F.max(c).cast("double").alias(f"_hi_{c}") for c in weights])
    j = df.crossJoin(F.broadcast(mm))
    score = None
    for c, w in weights.items():
        norm = F.try_divide(F.col(c).cast("double") - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))
        term = F.lit(w) * F.coalesce(norm, F.lit(0.0))
        score = term if score is None else score + term
    return j.withColumn("risk_score", score).drop(*[c for c in j.columns if c.startswith("_lo_") or c.startswith("_hi_")])


def _broker_factors(wh) -> DataFrame:
    """E-04's factors per broker: loss ratio, claims frequency, volume and high-risk share."""
    b = star.rollup(wh, "broker", ["Broker"], ["policies", "loss_ratio", "claims_frequency"])
    hr = (wh.silver("policy_risk", columns=("PolicyID", "AdjustedRiskBand"))
            .filter(F.col("AdjustedRiskBand").isin(*K.HIGH_RISK_BANDS)).select("PolicyID").distinct())
    # the columns that the roll-up reads, so that both share one exchange of the policies
    pol = wh.silver("policy", columns=star.POLICY_COLUMNS).select("PolicyID", F.coalesce("BrokerID", F.lit("Unknown")).alias("Broker"))
    hr_b = hr.join(pol, "PolicyID").groupBy("Broker").agg(F.count(F.lit(1)).alias("high_risk_policies"))
    return b.join(hr_b, "Broker", "left").withColumn(
        "high_risk_share", K.ratio(F.coalesce("high_risk_policies", F.lit(0)), "policies")).drop("high_risk_policies")


def e_04(wh) -> DataFrame:
    """E-04 broker risk score: the weighted percentile ranks of the factors, so one
    broker far off does not press the others together; an unknown factor ranks lowest."""
    j, score = staged(_broker_factors(wh), "broker-factors"), None
    for c, w in BROKER_SCORE_WEIGHTS.items():
        j = with_percent_rank(j, c, f"{c}_rank")
        term = F.lit(w) * F.col(f"{c}_rank")
        score = term if score is None else score + term
    return present(j.withColumn("risk_score", score))


def e_04_minmax(wh) -> DataFrame:
    """E-04 with min-max scaled factors instead of percentile ranks."""
    return present(_minmax(_broker_factors(wh), BROKER_SCORE_WEIGHTS))


def e_05(wh) -> DataFrame:
    """E-05 postcode-area risk score from loss ratio and claims frequency."""
    a = star.rollup(wh, "address", ["PostcodeArea"], ["policies", "loss_ratio", "claims_frequency"])
    return present(_minmax(a, POSTCODE_SCORE_WEIGHTS))


# Fixed value: the cut-off of "yesterday's" load in the E-01 query.
INCREMENTAL_CUTOFF = "1999-12-31"


def e_01(wh) -> DataFrame:
    """E-01: yesterday's premium fact (transactions up to the cut-off, at net
    premium 0 where today's feed corrects it) brought up to date from today's
    feed by its load-time mark; summarised per year, undated rows included."""
    from hearth.plans.incremental import incremental_load
    s = staged(wh.silver("premium_transactions").select("PremiumTransactionID", "TransactionDate", "InstallmentNumber", "NetPremium"),
               "premium-feed")                                  # target and feed read it
    known = F.coalesce(F.col("TransactionDate") <= F.lit(INCREMENTAL_CUTOFF).cast("date"), F.lit(False))
    corrected = F.col("InstallmentNumber") == 7
    day = lambda n: F.lit(wh.now.replace(day=n)).cast("timestamp")
    feed = s.withColumn("LoadDts", F.when(known & ~corrected, day(1)).otherwise(day(2)))
    target = s.filter(known).withColumn("NetPremium", F.when(corrected, 0).otherwise(F.col("NetPremium")).cast("decimal(18,2)")) \
              .withColumn("LoadDts", day(1))
    merged = incremental_load(target, feed, ["PremiumTransactionID"], "LoadDts")
    return present(merged.groupBy(F.year("TransactionDate").alias("year"))
                         .agg(F.count(F.lit(1)).alias("rows"), K.money_sum("NetPremium").alias("net_premium")))


def e_01_rollups(wh) -> DataFrame:
    """E-01 over three loads with corrections and late rows: the stored monthly
    and broker sums, kept up to date by signed deltas (``hearth.plans.rollups``).

    The first load has seven tenths of the transactions, of which some carry a
    wrong amount, month or policy; the second corrects the first two kinds and
    brings new rows; the third corrects the last, brings late rows (and
    delivers all of the first load again, with its old load time)."""
    from hearth.plans.rollups import LOAD_COL, PremiumRollups
    # every load reads both: silver is derived once
    s = staged(wh.silver("premium_transactions").select("PremiumTransactionID", "PolicyID", "TransactionDate", "NetPremium"), "rollup-source")
    policies = staged(wh.silver("policy").select("PolicyID", "BrokerID"), "rollup-policies")
    part = F.pmod(F.xxhash64("PremiumTransactionID"), F.lit(10))
    at = lambda df, n: df.withColumn(LOAD_COL, F.lit(wh.now.replace(day=n)).cast("timestamp"))
    first = at(s.filter(part < 7).withColumns({
        "NetPremium": F.when(part == 0, F.col("NetPremium") * 2 + 1).otherwise(F.col("NetPremium")).cast("decimal(18,2)"),
        "TransactionDate": F.when(part == 1, F.date_add("TransactionDate", 40)).otherwise(F.col("TransactionDate")),
        "PolicyID": F.when(part == 2, F.lit("P0")).otherwise(F.col("PolicyID"))}), 1)
    second = at(s.filter(part.isin(0, 1, 7, 8)), 2)
    third = at(s.filter(part.isin(2, 9)), 3).unionByName(first)
    schema = first.withColumn("NetPremium", F.col("NetPremium").cast("decimal(18,2)")).schema
    rollups = PremiumRollups(wh.spark, _scratch(wh, "rollups"), schema)
    for n, feed in enumerate((first, second, third), 1):
        feed = feed.withColumn("NetPremium", F.col("NetPremium").cast("decimal(18,2)"))
        rollups.load(n, feed, policies)
    return present(rollups.sums(3))


def e_03_stream(wh) -> DataFrame:
    """E-03 as the running monitor: the events arrive in two deliveries, the
    second of which brings the whole first one again; the stream is stopped after
    each and goes on from its checkpoint.  Then come an event older than the
    watermark, which is dropped, and one a day later, which closes all windows.
    Read back from the sink: every event once."""
    from hearth.streaming.monitor import start_monitor
    folder, events = _scratch(wh, "monitor"), wh.table("events")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(lo + (hi - lo) / 2)
    edge = lambda id_, ts: events.limit(1).withColumns({
        "event_id": F.lit(id_).cast(events.schema["event_id"].dataType), "ts": F.lit(ts).cast(events.schema["ts"].dataType)})
    deliveries = (events.filter(F.col("ts") <= middle), events,
                  edge(-1, hi + timedelta(days=1)).unionByName(edge(-2, lo)))
    for n, rows in enumerate(deliveries):
        rows.write.parquet(f"{folder}/in/delivery-{n}")
        start_monitor(wh.spark, f"{folder}/in/*", f"{folder}/out", f"{folder}/state", events.schema, trigger_once=True).awaitTermination()
    return present(wh.spark.read.parquet(f"{folder}/out"))


def e_03(wh) -> DataFrame:
    """E-03 claims monitor, batch form of the streaming job: events per
    hourly tumbling window and type (see hearth.streaming.monitor)."""
    from hearth.streaming.monitor import windowed_counts
    return present(windowed_counts(wh.table("events")))


def e_06(wh) -> DataFrame:
    """E-06 claim probability model (pyspark.ml logistic regression): one
    probability per policy.  Iterative fit, so no SQL twin."""
    from hearth.plans.model_claims import claim_probability
    return present(claim_probability(wh))


OPERATORS = {
    "snk_merge1": snk_merge1, "a_dupn": a_dupn, "a_dist": a_dist, "o_topk": o_topk, "w_lag": w_lag,
    "w_latestsnap": w_latestsnap, "p_26": p_26, "e_01": e_01, "e_03": e_03, "e_04": e_04, "e_05": e_05, "e_06": e_06,
    "snk_merge1_buckets": snk_merge1_buckets, "e_01_rollups": e_01_rollups, "e_03_stream": e_03_stream, "e_04_minmax": e_04_minmax,
}


# --------------------------------------------------------------------------
# P-01..P-10: each parser over a whole raw column (key, raw text, parsed value)
# --------------------------------------------------------------------------
RESERVE_FORMATS = (C.UK, C.ISO, C.YMD_SLASH, C.DMY_DASH, "yyyyMMdd")
PARSER_QUERIES = {
    "p_01": ("policy", "PolicyID", "PolicyID", C.trim_spaces),
    "p_02": ("claims", "ClaimID", "ClaimID", C.blank_to_null),
    "p_03": ("policy_risk", "PolicyID", "RiskScore", C.default_text),
    "p_04": ("policy_risk", "PolicyID", "RiskScore", lambda c: C.safe_decimal(c, 10, 2)),
    "p_05": ("address", "AddressID", "RebuildCostEstimate", lambda c: C.money(c, C.MONEY_CHARS_ADDRESS)),
    "p_05_reserve": ("claim_reserves", "ReserveID", "ReserveAmount", lambda c: C.money(c, C.MONEY_CHARS_RESERVE)),
    "p_06": ("claim_payments", "PaymentID", "PaymentDate", lambda c: C.safe_date(c, C.UK)),
    "p_07": ("policy", "PolicyID", "InceptionDate", lambda c: C.first_date(c, (C.UK, C.ISO, C.YMD_SLASH))),
    "p_08": ("claims", "ClaimID", "LossDate", lambda c: C.first_date(C.date_text_iso(c), (C.UK, C.ISO, C.ISO_TIME))),
    "p_08_prefix": ("claim_reserves", "ReserveID", "SnapshotDate",
                    lambda c: C.first_date(C.date_text_prefix(c), RESERVE_FORMATS)),
    "p_09": ("premium_transactions", "PremiumTransactionID", "PremiumDataQualityFlag", C.flag01),
    "p_09b": ("policy_risk", "PolicyID", "HasAlarm", C.flag_yn),
    "p_09c": ("claim_payments", "PaymentID", "LargeLossFlag", C.strict_flag),
    "p_10": ("premium_transactions", "PremiumTransactionID", "YearMonth", C.year_month),
}


def _parser_query(entity, key, col, fn):
    def q(wh) -> DataFrame:
        r = wh.raw(entity)
        return present(r.select(F.col(key).alias("Key"), F.col(col).alias("RawValue"), fn(F.col(col)).alias("Parsed")))
    return q


for _name, (_e, _k, _c, _fn) in PARSER_QUERIES.items():
    OPERATORS[_name] = _parser_query(_e, _k, _c, _fn)


def j_inner(wh) -> DataFrame:
    """J-INNER: expense rows joined to their category on the trimmed text key;
    rows of unknown categories vanish (counted by V-22-style audits)."""
    return present(wh.gold.expense_lines)


def a_cond(wh) -> DataFrame:
    """A-COND: conditional counts over the silver claims (SUM(CASE ...))."""
    from hearth.operators.quality import conditional_counts
    s = wh.silver("claims")
    return present(conditional_counts(s, {
        "closed_claims": F.col("ClaimStatus") == "Closed", "reopened_claims": F.col("ReopenedFlag") == "1",
        "fraud_flagged": F.col("FraudFlag") == "1", "catastrophe_claims": F.col("CatEventFlag") == "1",
        "complex_claims": F.col("ClaimComplexity") == "Complex"}))


def x_distinct(wh) -> DataFrame:
    """X-DISTINCT / A-DISTINCT: distinct normalised coverage types."""
    from hearth.plans.gold import normalised_cover
    return present(wh.silver("coverage").select(normalised_cover("CoverageType").alias("CoverageType")).distinct())


OPERATORS.update({"j_inner": j_inner, "a_cond": a_cond, "x_distinct": x_distinct})


# --------------------------------------------------------------------------
# sources and sinks, each written to and read back from the shared folder
# --------------------------------------------------------------------------
def _scratch(wh, name: str) -> str:
    """A new folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(wh.spark).rstrip('/')}/hearth-{name}-{uuid.uuid4().hex}"


def _csv_file(wh, entity: str, line, end: str = "") -> str:
    """The raw table of ``entity`` as a headered CSV folder; ``line`` maps its columns to one text."""
    path, raw = _scratch(wh, f"csv-{entity}"), wh.raw(entity)
    rows = raw.select(F.concat(line(raw.columns), F.lit(end)).alias("value"), F.monotonically_increasing_id().alias("_id"))
    # the reader drops the first line of each file, so each task's first row brings the header
    header = F.lit(",".join(raw.columns) + end + "\n")
    first = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows.select(F.when(first, F.concat(header, "value")).otherwise(F.col("value")).alias("value")).write.text(path)
    return path


def _joined(columns) -> F.Column:
    return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in columns])


def src_csv(wh) -> DataFrame:
    """SRC-CSV: the broker file (LF row ends) read with its staging schema."""
    return split_malformed(read_raw(wh.spark, _csv_file(wh, "broker", _joined), staging_schema("broker")))[0]


def src_csv_lf(wh) -> DataFrame:
    """SRC-CSV-LF: the claims file with CRLF row ends; quotes and no-break spaces stay as they are."""
    return split_malformed(read_raw(wh.spark, _csv_file(wh, "claims", _joined, "\r"), staging_schema("claims")))[0]


def src_badrows(wh) -> DataFrame:
    """SRC-BADROWS: a broker file in which some lines have a field too many or
    too few; every line comes out, good or with its reject reason."""
    def line(columns):
        whole, last = _joined(columns), F.right(F.trim("BrokerID"), F.lit(1))
        return F.when(last == "7", F.concat(whole, F.lit(",extra"))).when(last == "3", _joined(columns[:-1])).otherwise(whole)
    good, bad = load_staging(wh.spark, _csv_file(wh, "broker", line), "broker", max_share=0.5)
    return good.select("BrokerID", F.lit(None).cast("string").alias("RejectReason")).unionByName(
        bad.select("BrokerID", "RejectReason"))


def snk_overwrite(wh) -> DataFrame:
    """SNK-OVERWRITE / SNK-CTAS: a table written twice holds the second load only."""
    path, s = _scratch(wh, "overwrite"), wh.silver("broker")
    write_table(s.limit(0), path)
    write_table(s, path)
    return present(wh.spark.read.parquet(path))


def snk_byname(wh) -> DataFrame:
    """SNK-BYNAME / SNK-BYCAT / SNK-TRUNC / SNK-CLONE: rows put into a clone of
    the broker table by column name; a column the feed lacks is NULL, one the
    table lacks is left out."""
    table = wh.silver("broker").drop("SilverLoadDts", "BronzeLoadDts", "SourceFile")
    feed = wh.silver("broker").select(*reversed([c for c in table.columns if c != "CommissionModel"]), F.lit(1).alias("Unasked"))
    path = _scratch(wh, "byname")
    write_table(align(table.limit(0), table.schema), path)                  # the empty clone
    write_table(align(feed, wh.spark.read.parquet(path).schema), path, mode="append")
    return present(wh.spark.read.parquet(path))


def snk_addcol(wh) -> DataFrame:
    """SNK-ADDCOL / P-24: a premium file without the optional columns; bronze adds them as NULL."""
    raw = wh.raw("premium_transactions").drop(*PREMIUM_OPTIONAL)
    return present(bronze_premium_transactions(raw, wh.now).select("PremiumTransactionID", "PolicyID", "NetPremium", *PREMIUM_OPTIONAL))


def snk_stamps(wh) -> DataFrame:
    """SNK-STAMP-FILE / -TS / -SYS: the load metadata of every bronze entity, with its rows."""
    out = None
    for e in ENTITIES:
        b = wh.bronze(e)
        g = b.groupBy(*[(F.col(c) if c in b.columns else F.lit(None).cast("string")).cast("string").alias(c)
                        for c in ("SourceFile", "SourceSystem", "BronzeLoadDts")]).agg(F.count(F.lit(1)).alias("rows"))
        g = g.select(F.lit(e).alias("entity"), "SourceFile", "SourceSystem", F.col("BronzeLoadDts").alias("loaded_at"), "rows")
        out = g if out is None else out.unionByName(g)
    return out


# --------------------------------------------------------------------------
# joins, top rows, extensions
# --------------------------------------------------------------------------
def j_anti(wh) -> DataFrame:
    """J-ANTI: policies without a premium transaction."""
    return present(anti(wh.silver("policy").select("PolicyID", "PolicyStatus"),
                        wh.silver("premium_transactions").select("PolicyID"), ["PolicyID"]))


def j_anti_expr(wh) -> DataFrame:
    """J-ANTI-EXPR: the coverage dimension of an earlier load, which knew
    buildings and contents only, brought up to date: new types after the greatest key."""
    s = wh.silver("coverage")
    earlier = dim_coverage_from(s.filter(F.upper(F.trim("CoverageType")).isin("BUILDINGS", "CONTENTS")), wh.now)
    return present(dim_coverage_from(s, wh.now, current=earlier).select("CoverageKey", "CoverageType"))


def rpt_broker_policy(wh) -> DataFrame:
    """J-MERGED: every policy with its broker's attributes, one wide table."""
    b = star.broker_dim(wh).select(F.col("_dk").alias("BrokerID"), "BrokerName", "Channel")
    return present(wh.silver("policy").select("PolicyID", "BrokerID", "ProductType", "PolicyStatus", "InceptionDate", "ExpiryDate")
                     .join(b, "BrokerID", "left"))


def rpt_claim_payment(wh) -> DataFrame:
    """J-MERGED: every payment with its claim's attributes, one wide table."""
    c = wh.gold.fact_claim.select("ClaimID", "PolicyID", "LossDate", "ClaimStatus", "Severity")
    return present(wh.silver("claim_payments").select("PaymentID", "ClaimID", "PaymentDate", "PaymentAmount", "ClaimType")
                     .join(c, "ClaimID", "left"))


def o_top(wh, k: int = 20) -> DataFrame:
    """O-TOP: the first rows of a table by key."""
    return present(wh.silver("policy").select("PolicyID", "CustomerID", "PolicyStatus").orderBy("PolicyID").limit(k))


def e_02(wh, year: int = 1998) -> DataFrame:
    """E-02: the premium fact laid out by year and month; one year is read back, the others' folders are not."""
    path = _scratch(wh, "premium-by-month")
    write_table(wh.silver("premium_transactions").select("Year", "Month", "NetPremium"), path, partition_by=("Year", "Month"))
    f = wh.spark.read.parquet(path).filter(F.col("Year") == year)
    return present(f.groupBy("Year", "Month").agg(F.count(F.lit(1)).alias("rows"), K.money_sum("NetPremium").alias("net_premium")))


def d_01_second_load(wh) -> DataFrame:
    """D-01 over two loads: the first knew only freehold addresses, all in
    'Oldtown'; the second merges today's rows into it.  Known addresses keep
    their key, new ones follow the greatest, the unknown member stays."""
    store = _scratch(wh, "first-load")
    s = wh.silver("address").drop("PostcodeArea", "CustomerID", "BronzeLoadDts", "SilverLoadDts", "SourceFile")
    first = s.filter(F.col("Tenure") == "Freehold").withColumn("City", F.lit("Oldtown"))
    dim = assign_key(first, ["AddressID"], "AddressKey").withColumn("GoldLoadDts", F.lit(wh.now).cast("timestamp"))
    write_table(with_unknown(dim, {"AddressKey": -1, "AddressID": "UNKNOWN"}), f"{store}/gold/dim_address")
    second = type(wh)(wh.spark, wh.sf_dir, now=wh.now.replace(day=2), as_of=wh.as_of, previous_store=store)
    d = second.gold.dim_address
    return present(d.select("AddressKey", "AddressID", "City", "Tenure", F.coalesce((F.col("GoldLoadDts") > F.lit(wh.now)).cast("int"), F.lit(0)).alias("Changed")))


def e_06_calibration(wh) -> DataFrame:
    """E-06 in one row: with a free intercept the mean predicted probability equals the share of policies with a claim."""
    from hearth.plans.model_claims import claim_probability
    p = claim_probability(wh)
    t = p.agg(F.count(F.lit(1)).alias("policies"), F.sum("has_claim").alias("policies_with_claim"),
              F.avg("claim_probability").alias("_p"), F.avg("has_claim").alias("_l"))
    return present(t.select("policies", "policies_with_claim", (F.abs(F.col("_p") - F.col("_l")) < 0.001).cast("int").alias("calibrated")))


def e_06_trees(wh) -> DataFrame:
    """E-06 by gradient-boosted trees: every policy's probability, fitted without the held-out fold."""
    from hearth.plans.model_claims import tree_scores
    return present(tree_scores(wh))


def e_06_folds(wh) -> DataFrame:
    """E-06 in one row: fold sizes, and whether the trees rank the held-out policies better than
    chance and predict them better than the fold's own share of claims does."""
    from hearth.plans.model_claims import TEST, TRAIN, evaluation, tree_scores
    e = evaluation(tree_scores(wh))
    at = lambda which, c: F.max(F.when(F.col("fold") == which, F.col(c)))
    return present(e.agg(
        at(TRAIN, "policies").alias("train_policies"), at(TRAIN, "with_claim").alias("train_with_claim"),
        at(TEST, "policies").alias("test_policies"), at(TEST, "with_claim").alias("test_with_claim"),
        (at(TEST, "auc") > 0.5).cast("int").alias("ranks_better"),
        (at(TEST, "brier") < at(TEST, "brier_of_share")).cast("int").alias("predicts_better")))


def e_06_evaluation(wh) -> DataFrame:
    """E-06: AUC and Brier score of both folds."""
    from hearth.plans.model_claims import evaluation, tree_scores
    return present(evaluation(tree_scores(wh)))


def e_06_deciles(wh) -> DataFrame:
    """E-06: calibration of the held-out fold by decile of the score."""
    from hearth.plans.model_claims import deciles, tree_scores
    return present(deciles(tree_scores(wh)))


OPERATORS.update({f.__name__: f for f in (
    e_06_trees, e_06_folds, e_06_evaluation, e_06_deciles, src_csv, src_csv_lf, src_badrows, snk_overwrite, snk_byname, snk_addcol, snk_stamps, j_anti, j_anti_expr, rpt_broker_policy,
    rpt_claim_payment, o_top, e_02, d_01_second_load, e_06_calibration)})
