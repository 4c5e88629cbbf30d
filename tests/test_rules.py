"""Rule branches on hand-made rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.operators import conform, decisions, grading
from creditloom.operators.features import bureau_features, reject_leaky
from creditloom.operators.payments import payment_flags, payment_risk, with_weights
from creditloom.operators.reasons import top_reasons
from creditloom.operators.rules import hard_rules, point_thresholds, points_engine

SCHEMA = ("id int, fico double, qi string, partner string, d60 double, inq6 double, tl_total double, tl_delin double, pastdue double, revutil double, "
          "plaid_balance double, plaid_recentNSFs double, prove_phone_trust_score double, prove_verified double, taktile_status string, "
          "giact_bankruptcy_count double, negative_balance_days_90d double")
CLEAN = dict(fico=720.0, qi="HFHT", partner=None, d60=0.0, inq6=0.0, tl_total=20.0, tl_delin=0.0, pastdue=0.0, revutil=10.0, plaid_balance=100.0,
             plaid_recentNSFs=0.0, prove_phone_trust_score=900.0, prove_verified=1.0, taktile_status="success", giact_bankruptcy_count=0.0, negative_balance_days_90d=0.0)


def _score(spark, rows, **kw):
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    data = [tuple({**CLEAN, **r, "id": i}[n] for n in names) for i, r in enumerate(rows)]
    return points_engine(spark.createDataFrame(data, SCHEMA), **kw).orderBy("id").collect()


@pytest.mark.parametrize("row,points,reason", [
    ({}, 0, None),
    ({"qi": "missing", "partner": "partner_a"}, 30, "MISSING_QI_PARTNER_A: Missing QI + PARTNER_A partner (+30)"),
    ({"qi": None}, 10, "MISSING_QI_HIGH_FICO: Missing QI + FICO 700+ (+10)"),
    ({"qi": "MISSING", "fico": 650.0}, 20, "MISSING_QI_MID_FICO: Missing QI + FICO 600-699 (+20)"),
    ({"giact_bankruptcy_count": 2.0}, 15, "GIACT bankruptcy count=2 (+15)"),
    ({"fico": 549.0}, 15, "FICO < 550 (549) (+15)"), ({"fico": 550.0}, 8, "FICO 550-600 (550) (+8)"),
    ({"plaid_balance": -1234.5, "prove_verified": 0.0}, 15, "Negative bank balance=$-1,234 (+15)"),
    ({"plaid_recentNSFs": 3.0}, 10, "High NSFs=3 (+10)"), ({"pastdue": 500.0}, 0, None),
    ({"pastdue": 501.0}, 8, "High past due=$501 (+8)"), ({"negative_balance_days_90d": 6.0}, 8, "Extended negative balance history (6 days in 90d) (+8)"),
    ({"d60": 1.0}, 10, "Severe delinquencies (60d+)=1 (+10)"), ({"inq6": 6.0}, 8, "High inquiries (6mo)=6 (+8)"),
    ({"tl_total": 1.0}, 12, "Zero/minimal tradelines=1 (+12)"), ({"tl_total": None}, 0, None),
    ({"tl_delin": 11.0}, 10, "High delinquency rate=55.0% (+10)"),
    ({"plaid_balance": None, "prove_phone_trust_score": None, "taktile_status": None, "giact_bankruptcy_count": None}, 15, "All providers missing (+15)"),
    ({"plaid_balance": None, "prove_phone_trust_score": None, "taktile_status": None}, 8, "Minimal provider coverage (1/4) (+8)"),
    ({"plaid_balance": None}, 3, "Plaid missing (+3)"), ({"prove_phone_trust_score": None}, 3, "Prove missing (+3)"),
    ({"plaid_balance": -5.0}, 23, "Provider disagreement (1 contradictions) (+8)"),
    ({"partner": "PARTNER_B", "fico": 590.0}, 20, "PARTNER_B + Low FICO (590) (+12)"),
])
def test_point_rule(spark, row, points, reason):
    r = _score(spark, [row])[0]
    assert r.fraud_score == points
    assert (reason in r.fraud_reasons) if reason else r.fraud_reasons == []


def test_caps_and_award(spark):
    r = _score(spark, [dict(qi="MISSING", fico=500.0, giact_bankruptcy_count=1.0, plaid_balance=-10.0, plaid_recentNSFs=5.0, pastdue=900.0,
                            negative_balance_days_90d=9.0, d60=3.0, inq6=9.0, tl_total=1.0, tl_delin=1.0, partner="PARTNER_B", revutil=90.0)])[0]
    assert (r.pts_business, r.pts_financial, r.pts_bureau, r.pts_interaction) == (30, 35, 25, 20)
    assert not any("GIACT" in x for x in r.fraud_reasons)          # cap already reached
    assert any(x == "Zero/minimal tradelines=1 (+7)" for x in r.fraud_reasons)
    assert r.fraud_decision == "decline"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries({
    "fico": st.one_of(st.none(), st.floats(300, 850)), "qi": st.sampled_from([None, "", "MISSING", "HFHT", "lflt"]),
    "partner": st.sampled_from([None, "PARTNER_A", "PARTNER_B", "x"]), "d60": st.one_of(st.none(), st.floats(0, 9)),
    "plaid_balance": st.one_of(st.none(), st.floats(-1e4, 1e4)), "tl_total": st.one_of(st.none(), st.floats(0, 40))}), min_size=1, max_size=20))
def test_category_caps_hold(spark, rows):
    for r in _score(spark, rows, with_reasons=False):
        assert all(0 <= r[f"pts_{k}"] <= cap for k, cap in K.POINT_CAPS.items())
        assert r.fraud_score == sum(r[f"pts_{k}"] for k in K.POINT_CAPS)


def test_thresholds():
    assert point_thresholds("conservative") == (20, 55)
    assert point_thresholds("moderate", reject=60) == (25, 60)
    with pytest.raises(ValueError):
        point_thresholds("nope")


def test_hard_rules(spark):
    rows = [(1, 1, "HFHT", 700.0, None, 0.0, 0), (2, 0, None, 599.0, None, 0.0, 5), (3, 0, "MISSING", 700.0, "partner_a", 0.0, 0), (4, 0, "HFHT", 549.0, None, 0.0, 0),
            (5, 0, "HFHT", 619.0, None, 4.0, 3), (6, 0, "HFHT", None, None, 9.0, 0), (7, 0, "HFHT", 620.0, None, 4.0, 2)]
    df = spark.createDataFrame(rows, "id int, has_prior_bad int, qi string, fico double, partner string, d60 double, lu_connected_loans int")
    got = {r.id: (r.fraud_decision, r.fraud_rules_triggered) for r in hard_rules(df).collect()}
    assert got == {1: ("decline", "prior_bad_auto_decline"), 2: ("decline", "missing_qi_low_fico"), 3: ("decline", "missing_qi_partner_a"),
                   4: ("review", "extreme_subprime"), 5: ("review", "bureau_stress|entity_cluster"), 6: ("approve", ""), 7: ("approve", "")}


def test_cascades_at_the_thresholds(spark):
    rows = [("decline", 0.0, "A"), ("review", 0.9, "A"), ("pass", 0.25, "A"), ("pass", 0.15, "A"), ("pass", 0.1, "E"), ("pass", 0.1, "A")]
    df = spark.createDataFrame(rows, "fraud_decision string, pd double, grade string")
    assert [r.decision for r in decisions.cascade(df).collect()] == ["decline", "review", "decline", "review", "review", "approve"]
    assert [r.decision for r in decisions.short_cascade(df).collect()] == ["decline", "decline", "review", "approve", "approve", "approve"]


def test_grade_e_and_review_optimisation(spark):
    df = spark.createDataFrame([("review", "E", 0.1, "partner_a"), ("review", "E", 0.41, None), ("review", "E", 0.40, None), ("review", "D", 0.05, None)],
                               "decision string, grade string, pd double, partner string")
    out = decisions.review_optimisation(decisions.grade_e(df)).collect()
    assert [r.grade_e_action for r in out] == ["PARTNER_GRADE_E_AUTO_DECLINE", "HIGH_PD_GRADE_E_DECLINE", "GRADE_E_REPRICING", ""]
    assert [r.decision for r in out] == ["decline", "decline", "decline", "approve"]
    assert [r.grade_e_repricing for r in out] == [None, None, 1.55, None]
    with pytest.raises(ValueError):
        decisions.review_optimisation(df, True, 0.1, 0.2)


def test_reasons_sorted_deduped_capped(spark):
    raw = ["Plaid missing", "High NSFs=3", "Prior default by connected entity", "Plaid missing", "custom"] + [f"Low FICO ({i})" for i in range(9)]
    got = spark.range(1).select(top_reasons(F.array(*[F.lit(x) for x in raw])).alias("r")).first().r
    assert got[:3] == ["Prior default by connected entity", "High NSFs=3", "custom"] and len(got) == 8 and "Plaid missing" not in got


def test_grading(spark):
    df = spark.createDataFrame([(0.0399, None), (0.04, None), (0.5, None), (0.5, "PARTNER_B"), (0.01, "partner_b")], "pd double, partner string")
    s = grading.GradeScheme("7grade", K.GRADE_SCHEMES["7grade"][2], K.GRADE_SCHEMES["7grade"][1])
    assert [(r.grade, r.pricing_tier) for r in grading.grade(df, s).collect()] == [("A", 1), ("B", 2), ("G", 7), ("G", 7), ("B", 2)]
    assert grading.spaced_labels(("A", "B", "C", "D", "F"), 3) == ("A", "C", "F")
    flat = grading.fit_scheme(spark.range(100).select(F.lit(0.1).alias("pd")), scheme="5grade")
    assert flat.boundaries == (0.1,) and len(flat.grades) == 2
    assert [r.grade for r in grading.fixed_grade(spark.createDataFrame([(0.06,), (0.2,), (0.0,)], "pd double")).collect()] == ["B", "D", "A"]


def test_optimal_iv_beats_quantiles(spark):
    df = spark.range(4000).select((F.col("id") / 4000.0).alias("pd"), ((F.hash("id") % 100 + 100) % 100 < F.col("id") / 4000.0 * 60).cast("int").alias("is_bad"))
    best = grading.fit_optimal_iv(df)
    plain = grading.boundary_iv(df, (0.2, 0.4, 0.6, 0.8)).first()["iv"]
    assert best.iv >= plain - 1e-9
    assert abs(grading.boundary_iv(df, best.boundaries).first()["iv"] - best.iv) < 1e-6


def test_payment_flags_missing_and_weights(spark):
    df = spark.createDataFrame([(None, -0.3, 2.0), (1.0, -0.2, 1.0)], "nsf_count double, payment_decline_pct double, nsf_cluster_max double")
    f = payment_flags(df).collect()
    assert [(r.flag_any_nsf, r.flag_declining, r.flag_nsf_cluster, r.flag_high_cv) for r in f] == [(0, 1, 1, 0), (1, 0, 0, 0)]
    w = with_weights({"flag_any_nsf": 3})
    assert payment_risk(df, w).collect()[1].flag_count == 3 and K.PAYMENT_FLAGS["flag_any_nsf"][3] == 1
    assert payment_risk(df).collect()[0].risk_tier == "orange"


def test_leaky_and_required_columns(spark):
    with pytest.raises(ValueError):
        reject_leaky(spark.range(1).withColumn("has_plaid", F.lit(1)))
    with pytest.raises(ValueError):
        conform.require_columns(spark.range(1))
    with pytest.raises(ValueError):
        conform.require_columns(spark.createDataFrame([], "fico double"))
    assert conform.missing_optional(spark.createDataFrame([(1.0, "a")], "fico double, qi string")) == ["partner", "shop_qi"]


def test_features_with_everything_missing(spark):
    df = spark.createDataFrame([tuple([None] * 13), tuple([300.0] + [None] * 12), tuple([850.0] + [None] * 12)], ", ".join(f"{k} double" for k in K.BUREAU_COLUMNS))
    assert [r.fico_band for r in bureau_features(df).collect()] == [5.0, 1.0, 9.0]


def test_payments_of_one_hot_loan(spark):
    """A loan with all the rows: streaks and trends over many days; the islands are dealt out by more than the loan."""
    from creditloom.operators.payments import payment_features
    rows = [(1, d, d, float(100 + d), 1 if 300 <= d < 345 or d % 40 == 0 else 0, "CUSTOMER") for d in range(600)]
    df = spark.createDataFrame(rows, "loan_id long, day_no int, payment_no int, amount double, is_returned int, payment_type string")
    f = payment_features(df)
    r = f.first()
    # day 320 is inside the run of 45, and no other returned day touches it
    assert r.max_consecutive_nsf == 45 and r.n_payments == 600
    assert abs(r.payment_decline_pct - ((100 + 598) - (100 + 1)) / (100 + 1)) < 1e-9
    plan = f._jdf.queryExecution().toString()
    assert "hashpartitioning(loan_id" in plan and "_part" in plan


def test_money_that_rounds_to_zero_has_no_sign(spark):
    from creditloom.functions.clean import money
    df = spark.createDataFrame([(-0.29,), (-0.5,), (-1234.5,), (2.5,), (1234567.5,)], "v double")
    assert [r[0] for r in df.select(money(df.v)).collect()] == ["$0", "$0", "$-1,234", "$2", "$1,234,568"]


def test_payments_are_shuffled_once(spark):
    """Loans of few payments need one shuffle, and large ones among them the same figures as alone."""
    from creditloom.operators.payments import payment_features
    rows = [(k, d, d, float(100 + d), 1 if d % 7 < 2 else 0, "CUSTOMER" if d % 5 else "RECOVERY") for k, n in ((1, 600), (2, 40), (3, 5)) for d in range(n)]
    df = spark.createDataFrame(rows, "loan_id long, day_no int, payment_no int, amount double, is_returned int, payment_type string")
    small = payment_features(df.where("loan_id > 1"))
    assert small._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    both = {r.loan_id: r for r in payment_features(df).collect()}
    assert set(both) == {1, 2, 3} and all(both[r.loan_id] == r for r in small.collect())
    assert both[1] == payment_features(df.where("loan_id = 1")).first()


def test_history_of_large_identities_is_the_same(spark):
    """An identity above the limit goes by slices; the figures of both ways agree."""
    from creditloom.operators.entity import prior_history
    rows = [(i, i % 7, k, f"20{i % 20:02}-01-{1 + i % 28:02}", "DEFAULT" if i % 3 else "PAID") for k, n in ((1, 300), (2, 700)) for i in range(n)]
    df = spark.createDataFrame(rows, "loan_id long, shop_id long, ident_key long, d string, loan_state string").selectExpr("*", "to_date(d) as signing_date")
    got = {(r.ident_key, r.loan_id): r for r in prior_history(df).collect()}
    assert len(got) == 1000
    for k in (1, 2):
        loans = [r for (i, _), r in got.items() if i == k]
        for r in loans[::37]:
            before = [x for x in loans if x.signing_date < r.signing_date]
            assert (r.prior_loans_ssn, r.prior_bad_ssn, r.prior_paid_ssn, r.prior_shops_ssn) == (
                len(before), sum(x.loan_state == "DEFAULT" for x in before), sum(x.loan_state == "PAID" for x in before), len({x.shop_id for x in before}))
