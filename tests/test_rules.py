import pytest
from pyspark.sql import functions as F

from txnguard.operators import blacklist, rules
from txnguard.operators.features import add_features


def scored(df, probability=0.1, prediction=0.0, listed=None):
    ready = add_features(df).withColumns(
        {"fraud_probability": F.lit(probability), "prediction": F.lit(prediction)}
    )
    return rules.score_rules(ready, listed)


DRAINED = {"type": "TRANSFER", "oldbalanceOrg": 300.0, "newbalanceOrig": 0.0, "nameDest": "C5"}
LARGE_DRAINED = {**DRAINED, "amount": 350000.0}


@pytest.mark.parametrize(
    "change, probability, prediction, listed, rule_score, hybrid, alert, source",
    [
        (DRAINED, 0.05, 0.0, ["C5"], 1.0, 0.335, 1.0, "BLACKLIST_RULE+DRAIN"),
        (LARGE_DRAINED, 0.9, 1.0, [], 1.0, 0.93, 1.0, "ML+DRAIN+LARGE_TXN"),
        (DRAINED, 0.95, 1.0, ["C5"], 1.0, 0.965, 1.0, "ML+BLACKLIST_RULE+DRAIN"),
        ({"nameDest": "C5"}, 0.02, 0.0, ["C5"], 1.0, 0.314, 1.0, "BLACKLIST_RULE"),  # any type
        (DRAINED, 0.5, 0.0, [], 0.5, 0.5, 0.0, "NONE"),
        ({}, 1.0, 1.0, [], 0.0, 0.7, 0.0, "NONE"),  # the model alone cannot alert
        ({}, 1.2, 1.0, [], 0.0, 0.84, 1.0, "ML_MODEL"),
        ({}, 1.2, 0.0, [], 0.0, 0.84, 1.0, "HYBRID_SCORE"),
    ],
)
def test_scores_and_labels(rows, change, probability, prediction, listed, rule_score, hybrid, alert, source):
    row = scored(rows(change), probability, prediction, listed).first()
    assert row.rule_score == rule_score
    assert row.hybrid_score == pytest.approx(hybrid)
    assert (row.is_alert, row.alert_source) == (alert, source)
    assert row.is_blacklist_destination == row.is_rule_blacklist


def test_threshold_is_inclusive(rows):
    ready = rows({}).withColumns(
        {
            "fraud_probability": F.lit(0.75),
            **{c: F.lit(0.0) for c in ("is_rule_blacklist", "is_rule_drain", "is_rule_large_txn")},
        }
    )
    from txnguard.schema import ScoringConfig

    even = ScoringConfig(probability_share=1.0, rule_share=1.0)
    assert rules.add_hybrid_score(ready, even).first().is_alert == 1.0


def test_drain_needs_an_outgoing_type(rows):
    change = {"newbalanceOrig": 0.0}
    found = scored(rows({**change, "type": "PAYMENT"}, {**change, "type": "CASH_OUT"}, {**change, "type": None}))
    assert [r.is_rule_drain for r in found.collect()] == [0.0, 1.0, 0.0]


def test_invariants_over_given_tables(spark):
    from given import TABLES
    from txnguard.catalog.queries import QUERIES

    gold = QUERIES["gold_table"](spark, TABLES)
    bad = gold.filter(
        "rule_score NOT BETWEEN 0 AND 1 OR (is_alert = 1) = (alert_source = 'NONE') "
        "OR is_rule_blacklist <> is_blacklist_destination"
    )
    assert bad.count() == 0


FORMS = {
    "literals": {},
    "broadcast": {"max_literals": 0},
    "shuffled": {"max_literals": 0, "max_rows": 0},
}


@pytest.mark.parametrize("form", FORMS)
def test_list_forms_agree(spark, rows, form):
    df = rows({"nameDest": "C1"}, {"nameDest": "C2"}, {"nameDest": "C1"}, {"nameDest": None})
    source = spark.createDataFrame([(" c1 ",), ("C1",), ("C9",)], "account STRING")
    listed = blacklist.account_list(source, **FORMS[form])
    flags = sorted((r.nameDest or "", r.hit) for r in blacklist.flag_listed(df, listed, "hit").collect())
    assert flags == [("", 0.0), ("C1", 1.0), ("C1", 1.0), ("C2", 0.0)]
    assert blacklist.only_listed(df, listed).count() == 2
    assert blacklist.only_unlisted(df, listed).count() == 2


def test_names_and_rows_take_one_way(spark, rows):
    names = [None, "", " \t", " c1\t", "C1", "c2"]
    listed = spark.createDataFrame([(n,) for n in names], "account STRING")
    found = rows({"nameDest": "C1"}, {"nameDest": "C2"}, {"nameDest": "C3"}, {"nameDest": None})
    for source in (names, listed, blacklist.account_list(listed, max_literals=0), blacklist.account_list(names, max_literals=0)):
        assert [r.hit for r in blacklist.flag_listed(found, source, "hit").orderBy("nameDest").collect()] == [0.0, 1.0, 1.0, 0.0]
        assert sorted(r.nameDest for r in blacklist.only_listed(found, source).collect()) == ["C1", "C2"]
        assert {r.nameDest for r in blacklist.only_unlisted(found, source).collect()} == {"C3", None}
    many = [f"C{i}" for i in range(3000)]
    assert blacklist.account_list(many).literals is None
    assert blacklist.only_listed(found, many).count() == 3
    assert blacklist.only_listed(found, []).count() == 0 and blacklist.only_unlisted(found, None).count() == 4


def test_broadcast_only_within_measured_bounds(spark):
    source = spark.range(50).select(F.concat(F.lit("C"), "id").alias("account"))
    assert blacklist.account_list(source).literals is not None
    assert blacklist.account_list(source, max_literals=0).fits_broadcast
    assert not blacklist.account_list(source, max_literals=0, max_rows=49).fits_broadcast
    assert not blacklist.account_list(source, max_literals=0, max_bytes=10).fits_broadcast


def test_hot_account_is_split_in_the_shuffled_form(spark):
    """A third of all rows on one account: the join splits that partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        account = F.when(F.col("id") % 3 == 0, "C0").otherwise(F.concat(F.lit("C"), F.col("id") % 5000))
        df = spark.range(0, 300_000, 1, 16).select("id", account.alias("nameDest"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        source = spark.range(0, 5000, 2).select(F.concat(F.lit("C"), "id").alias("account"))
        listed = blacklist.account_list(source, max_literals=0, max_rows=0)
        flagged = blacklist.flag_listed(df, listed, "hit")
        found = flagged.collect()
        assert len(found) == 300_000
        assert all(r.hit == float(int(r.nameDest[1:]) % 2 == 0) for r in found)
        assert "skew=true" in flagged._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_counters(rows):
    found = rules.alert_counters(scored(rows(LARGE_DRAINED, {}, DRAINED), 0.9, 1.0)).first()
    # Model and rule counters count raised flags, not alerts.
    assert tuple(found) == (3, 2, 3, 2)


def test_short_lists_cost_no_job(spark, rows):
    """Names given by the caller are literals: choosing their form and planning with them runs nothing."""
    df = rows({"nameDest": "C1"}, {"nameDest": ""})
    context = spark.sparkContext
    context.setJobGroup("short-list", "no job")
    try:
        listed = blacklist.account_list([" c1\t", "C9", None, " "])
        flagged = blacklist.flag_listed(df, listed, "hit")
        kept = blacklist.only_unlisted(df, [" c1\t", ""])
        flagged.explain()
        assert not context.statusTracker().getJobIdsForGroup("short-list")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert [r.hit for r in flagged.orderBy("nameDest").collect()] == [0.0, 1.0]
    assert [r.nameDest for r in kept.collect()] == [""]
