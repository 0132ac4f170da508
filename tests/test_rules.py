"""One test per semantic rule and per edge case, on hand-made events."""

import pytest
from pyspark.sql import functions as F

from shopsight.config import ChurnConfig, RfmConfig, SilverConfig, UpsellConfig
from shopsight.functions import labels
from shopsight.functions.events import with_category
from shopsight.operators import bronze, churn, features, metrics, quality, rfm, scoring, silver, upsell
from shopsight.operators.panels import behaviour, overview
from shopsight.functions.events import as_facts

RAW = "event_time string, event_type string, product_id string, category_id string, category_code string, brand string, price string, user_id string, user_session string"


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# Bronze


def raw_row(**kw):
    row = dict(event_time="2019-11-01 10:00:00 UTC", event_type="view", product_id="1", category_id=None,
               category_code="a.b.c", brand="X", price="1.50", user_id="7", user_session="s")
    row.update(kw)
    return tuple(row.values())


def test_bad_text_becomes_null_instead_of_failing(spark):
    rows = [
        raw_row(),
        raw_row(event_time="not-a-time"),
        raw_row(price="abc", product_id="x", category_code="a"),
        raw_row(price="-3"),
        raw_row(price=None),
        raw_row(price="NaN"),
        raw_row(user_id="u7"),
        raw_row(event_type=None),
    ]
    out = bronze.clean_events(spark.createDataFrame(rows, RAW))
    assert out.count() == 5
    assert {r.price for r in out.collect()} == {1.5, 0.0}
    assert {(r.category_root, r.category_sub) for r in out.collect()} == {("a", "b"), ("a", None)}


def test_type_is_normalised_before_it_is_filtered(spark):
    out = bronze.clean_events(spark.createDataFrame([raw_row(event_type=" VIEW "), raw_row(event_type="error")], RAW))
    assert [r.event_type for r in out.collect()] == ["view"]


def test_blank_brand_code_and_session(spark):
    row = bronze.clean_events(
        spark.createDataFrame([raw_row(brand="  ", category_code=" ", user_session=" ")], RAW)
    ).first()
    assert (row.brand, row.category_code, row.category_root, row.user_session) == (None, None, None, None)


def test_month_filter(spark):
    rows = [raw_row(), raw_row(event_time="2019-12-01 00:00:00 UTC")]
    assert bronze.clean_events(spark.createDataFrame(rows, RAW), month="2019-12").count() == 1


def test_dedup_is_by_key_and_deterministic(spark):
    rows = [raw_row(price=p) for p in ("9", "3", "5")] * 200 + [raw_row(product_id="2")]
    out = bronze.dedup_events(bronze.clean_events(spark.createDataFrame(rows, RAW).repartition(7)))
    assert values(out, "product_id", "price") == [(1, 3.0), (2, 1.5)]


# Silver


def session(events_from, sizes):
    rows = []
    for name, size in sizes.items():
        rows += [(f"2019-11-01 10:00:{i:02d}", "view", i, "a.b", None, 1.0, 1, name) for i in range(size)]
    return events_from(rows).withColumn("price_raw", F.col("price"))


def test_bot_limit_is_inclusive_and_null_sessions_stay(events_from):
    out = silver.build_silver(session(events_from, {"at": 5, "over": 6, None: 9}), SilverConfig(bot_limit=5))
    sizes = {r.user_session: r["count"] for r in out.groupBy("user_session").count().collect()}
    assert sizes == {"at": 5, None: 9}


def test_all_events_of_a_bot_session_go_and_unpriced_purchases_too(events_from, spark):
    rows = [("2019-11-01 10:00:00", t, 1, "a.b", None, p, 1, s) for t, p, s in
            [("view", 1.0, "x"), ("purchase", None, "x"), ("purchase", 2.0, "x"), ("view", None, "x")]]
    out = silver.build_silver(events_from(rows).withColumn("price_raw", F.col("price")).fillna(0.0, ["price"]))
    assert values(out, "event_type", "price") == [("purchase", 2.0), ("view", 0.0), ("view", 1.0)]
    assert {r.brand for r in out.collect()} == {"unknown"}


def test_excluded_keys_leave_nulls_and_split_a_hot_key(spark):
    from shopsight.operators.joins import exclude_keys

    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("s"), F.col("id") % 50)).alias("k"), "id")
    keys = spark.createDataFrame([("hot",), ("s3",), ("s4",)], "k string")
    kept = {r.id for r in exclude_keys(rows, keys, "k").collect()}
    assert kept == {i for i in range(1000, 3000) if i % 7 == 0 or i % 50 not in (3, 4)}


# Quality


def test_metrics_count_each_row_once(spark):
    rows = [raw_row(), raw_row(), raw_row(user_id=None, event_type="bad"), raw_row(event_type=None), raw_row(price=None),
            raw_row(price="-1")]
    m = quality.dq_metrics(spark.createDataFrame(rows, RAW)).first()
    assert (m.total_rows, m.null_user_id, m.null_price, m.negative_price, m.invalid_event_type) == (6, 1, 1, 1, 2)
    assert m.valid_rows == 4
    assert (m.duplicate_session_events, m.duplicate_events) == (4, 3)
    assert m.null_user_pct == 16.67


def test_metrics_of_nothing(spark):
    m = quality.dq_metrics(spark.createDataFrame([], RAW)).first()
    assert (m.total_rows, m.valid_rows, m.null_user_pct) == (0, 0, 0.0)


def test_rules_are_evaluated(spark):
    report = quality.rule_report(spark.createDataFrame([raw_row(user_id=None), raw_row(price="-2")], RAW))
    assert {r["check"]: r.status for r in report.collect()} == {
        "row_count_positive": "passed", "user_id_not_null": "failed",
        "event_type_in_set": "passed", "price_not_negative": "failed"}
    with pytest.raises(ValueError, match="user_id_not_null"):
        quality.require_passed(report)


def test_contract_fails_without_the_column(spark):
    report = quality.feature_contract(spark.range(200))
    assert {r["check"]: r.status for r in report.collect()} == {"row_count": "passed", "segment_present": "failed"}


def test_missing_columns_fail_unless_repair_is_asked_for(spark):
    with pytest.raises(ValueError, match="n_carts"):
        quality.require_columns(spark.range(1), ("id", "n_carts"))
    assert quality.require_columns(spark.range(1), ("id", "n_carts"), fill_missing=True).first().n_carts == 0


# RFM


def purchase(time, price, user, code="a.b", product=1, brand="x"):
    return (time, "purchase", product, code, brand, price, user, "s")


def test_recency_modes(events_from):
    events = events_from([purchase("2019-11-30 12:00:00", 1.0, 1), purchase("2019-11-29 23:59:59.999999", 1.0, 2)])
    elapsed = rfm.rfm_base(events, RfmConfig())
    calendar = rfm.rfm_base(events, RfmConfig(recency="calendar"))
    assert values(elapsed, "user_id", "recency") == [(1, 0), (2, 1)]
    assert values(calendar, "user_id", "recency") == [(1, 1), (2, 2)]


def test_purchase_at_the_reference_instant(events_from):
    assert rfm.rfm_base(events_from([purchase("2019-12-01 00:00:00", 1.0, 1)])).first().recency == 0


def test_minimum_price_and_zero_spend(events_from):
    events = events_from([purchase("2019-11-01", 0.0, 1), purchase("2019-11-01", 0.0, 2), purchase("2019-11-02", 5.0, 2)])
    assert values(rfm.rfm_base(events), "user_id", "frequency") == [(2, 2)]
    assert values(rfm.rfm_base(events, RfmConfig(min_purchase_price=0.01)), "user_id", "frequency") == [(2, 1)]


@pytest.mark.parametrize("method", ["percent_rank", "ntile", "qcut"])
def test_five_is_best_for_every_method(events_from, method):
    rows = []
    for user in range(1, 11):  # user 10 buys most, most often, last
        rows += [purchase(f"2019-11-{user:02d} {h:02d}:00:00", 10.0 * user, user) for h in range(user)]
    scored = rfm.customer_rfm(events_from(rows), RfmConfig(method=method))
    by_user = {r.user_id: r for r in scored.collect()}
    assert (by_user[10].r_score, by_user[10].f_score, by_user[10].m_score) == (5, 5, 5)
    assert (by_user[1].r_score, by_user[1].f_score, by_user[1].m_score) == (1, 1, 1)
    assert by_user[10].segment == "Champions" and by_user[1].segment == "Lost"


def test_equal_frequencies(events_from):
    events = events_from([purchase(f"2019-11-{d:02d}", float(d), d) for d in range(1, 21)])
    with pytest.raises(ValueError, match="frequency"):
        rfm.customer_rfm(events, RfmConfig(method="qcut"))
    assert {r.f_score for r in rfm.customer_rfm(events).collect()} == {3}


def test_single_buyer_and_no_buyer(events_from):
    assert rfm.customer_rfm(events_from([purchase("2019-11-01", 1.0, 1)])).count() == 1
    assert rfm.customer_rfm(events_from([])).count() == 0


def test_segments_cover_every_score_pair(spark):
    grid = spark.range(1, 6).withColumnRenamed("id", "r").withColumn("f", F.explode(F.sequence(F.lit(1), F.lit(5))))
    got = {(x.r, x.f): x.s for x in grid.withColumn("s", labels.segment(F.col("r"), F.col("f"))).collect()}
    assert got[(5, 4)] == "Champions" and got[(3, 5)] == "Loyal" and got[(5, 2)] == "Potential Loyalist"
    assert got[(2, 3)] == "At Risk" and got[(2, 2)] == "Needs Attention" and got[(2, 1)] == "Lost"
    assert got[(1, 3)] == "Can't Lose" and got[(1, 2)] == "Hibernating" and got[(1, 1)] == "Lost"
    assert set(got.values()) == {a[0] for a in labels.SEGMENT_ACTIONS}


def test_sample_is_capped_and_repeatable(events_from):
    scored = rfm.customer_rfm(events_from([purchase("2019-11-01", 1.0, u) for u in range(30)]), breadth=False)
    first, again = rfm.rfm_sample(scored, 10), rfm.rfm_sample(scored.repartition(5), 10)
    assert values(first, "user_id") == values(again, "user_id") and first.count() == 10


def test_contract_sees_an_empty_month(spark):
    from shopsight.operators import quality

    slices = spark.createDataFrame([("all",), ("2019-11",)], "slice string")
    panels = {
        "daily": spark.createDataFrame([("all", 1), ("all", 2)], "slice string, n int"),
        "list": spark.createDataFrame([(1,)], "n int"),
        "none": spark.createDataFrame([], "n int"),
    }
    got = {(r.panel, r.slice): (r["rows"], r.ok) for r in quality.panel_contract(panels, {"daily": 2}, slices).collect()}
    assert got == {("daily", "all"): (2, True), ("daily", "2019-11"): (0, False), ("list", "all"): (1, True), ("none", "all"): (0, False)}


# Features


def test_session_value_and_revenue(events_from):
    events = events_from([
        ("2019-11-01 10:00:00", "view", 1, "a.b", "x", 4.0, 9, "s"),
        ("2019-11-01 10:30:00", "purchase", 1, "a.b", "x", 6.0, 3, "s"),
        ("2019-11-01 10:30:00", "view", 1, "a.b", "x", 6.0, 3, None),
    ])
    row = features.session_features(events).first()
    assert (row.user_id, row.session_value, row.session_revenue, row.duration_minutes, row.converted) == (9, 10.0, 6.0, 30.0, 1)


def test_product_without_views_converts_at_zero(events_from):
    row = features.product_features(events_from([purchase("2019-11-01", 2.0, 1)])).first()
    assert (row.total_views, row.conversion_rate) == (0, 0.0)


def test_breadth_counts_known_roots(events_from):
    events = events_from([purchase("2019-11-01", 1.0, 1, code=c) for c in (None, "", "a", "a.b", "c")])
    assert features.user_features(events, "2019-12-01").first().unique_categories == 2


# Churn


def test_features_do_not_see_the_outcome_period(events_from):
    config = ChurnConfig()
    base = [purchase("2019-10-05", 1.0, 1), purchase("2019-10-05", 1.0, 2), ("2019-10-06", "view", 1, "a", "x", 1.0, 1, "s")]
    later = [purchase("2019-11-05", 9.0, 1, code="z", product=5), ("2019-11-06", "cart", 1, "a", "x", 1.0, 1, "s")]
    without = {r.user_id: r.asDict() for r in churn.churn_features(events_from(base), config).collect()}
    with_later = {r.user_id: r.asDict() for r in churn.churn_features(events_from(base + later), config).collect()}
    assert with_later[1].pop("churned") == 0 and without[1].pop("churned") == 1
    assert with_later == {**without, 1: without[1]}
    assert without[1]["recency"] == 27


def test_cohort_identities(events_from):
    events = events_from([purchase("2019-10-05", 1.0, u) for u in (1, 2, 3)] + [purchase("2019-11-01", 1.0, u) for u in (3, 4)])
    c = churn.cohort_retention(events, ChurnConfig()).first()
    assert (c.period_buyers, c.next_period_buyers, c.retained, c.churned, c.new_buyers) == (3, 2, 1, 2, 1)
    assert c.churn_rate == 66.666667
    assert values(churn.churn_labels(events, ChurnConfig()), "user_id", "churned") == [(1, 1), (2, 1), (3, 0)]


def test_churn_rate_without_buyers(events_from):
    assert churn.cohort_retention(events_from([]), ChurnConfig()).first().churn_rate == 0.0


# Upsell


def shop(events_from, rows):
    return upsell.as_demand(with_category(events_from(rows), "root"))


def view(user, code, n=1):
    return [("2019-11-01", "view", 1, code, "x", 1.0, user, "s")] * n


def test_constant_gap_scales_to_zero(events_from):
    demand = shop(events_from, view(1, "a", 3) + view(1, "b", 3))
    scores = upsell.category_opportunity(demand, UpsellConfig(min_views=1))
    assert values(scores, "category", "opportunity_score") == [("a", 0.0), ("b", 0.0)]


def test_category_bought_but_never_viewed_and_the_reverse(events_from):
    demand = shop(events_from, view(1, "a", 3) + [purchase("2019-11-01", 1.0, 1, code="b")])
    assert values(upsell.opportunity_panel(demand), "category", "score") == [("a", 3.0), ("b", 0.0)]
    assert upsell.top_purchased(demand, 5) == ["b"]


def test_recommendations(events_from):
    rows = view(1, "a", 40) + view(1, "b", 30) + view(1, "c", 20)
    rows += [purchase("2019-11-01", 1.0, 1, code="a"), purchase("2019-11-02", 1.0, 2, code="a"),
             purchase("2019-11-02", 1.0, 2, code="b"), *[purchase("2019-11-03", 2.0, 3, code=c) for c in "abc"]]
    events = events_from(rows)
    scored = rfm.customer_rfm(events, breadth=False)
    config = UpsellConfig(min_views=1, alpha=1.0)
    demand = upsell.as_demand(with_category(events, "root"))
    out = upsell.upsell_top_k(demand, scored, config)
    owned = {(r.user_id, r.category) for r in features.user_categories(with_category(events, "root")).collect()}
    got = {(r.user_id, r.category) for r in out.collect()}
    assert got == {(1, "b"), (1, "c"), (2, "c")} and not got & owned
    row = [r for r in out.collect() if (r.user_id, r.category) == (1, "b")][0]
    # buyers: a&a 3, a&b 2, a&c 1, so a lends b 2 / 6
    assert row.affinity == 0.3333 and row.opportunity == pytest.approx(0.5, abs=0.02)
    assert all(r.rank <= config.top_k for r in out.collect())


def test_affinity_rows_sum_to_hundred(events_from):
    rows = [purchase("2019-11-01", 1.0, u, code=c) for u, c in [(1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "c")]]
    sums = upsell.affinity_matrix(shop(events_from, rows), 3).groupBy("cat_x").agg(F.sum("affinity_pct").alias("s"))
    assert all(abs(r.s - 100) < 0.05 for r in sums.collect())


def test_pairs_over_a_catalogue_wider_than_one_mask(events_from, spark):
    import itertools
    from collections import Counter

    owned = {u: {f"c{(u * 37 + k * k) % 150:03d}" for k in range(20)} for u in range(40)}
    owned[99] = {f"c{i:03d}" for i in range(150)}
    rows = [purchase("2019-11-01", 1.0, u, code=c) for u, cats in owned.items() for c in cats]
    demand = shop(events_from, rows)
    want = Counter(p for cats in owned.values() for p in itertools.permutations(sorted(cats), 2))
    got = {(r.cat_x, r.cat_y): r.buyers for r in upsell.copurchase_pairs(demand).collect()}
    assert got == dict(want)
    support = {(r.user_id, r.target_category): r.shared_buyers for r in upsell.copurchase_support(demand).collect()}
    assert support == {(u, c): len(cats) - 1 for u, cats in owned.items() for c in cats if len(cats) > 1}


def test_pairs_of_nothing(events_from):
    assert upsell.copurchase_pairs(shop(events_from, [])).count() == 0


# Panels


def test_months_and_all(events_from):
    events = events_from([purchase("2019-10-01", 1.0, 1), purchase("2019-11-01", 2.0, 1)])
    got = values(overview.overview_kpis(as_facts(events), events), "slice", "total_customers", "total_revenue", "conversion_rate")
    assert got == [("2019-10", 1, 1.0, 100.0), ("2019-11", 1, 2.0, 100.0), ("all", 1, 3.0, 200.0)]


def test_dense_heatmap_and_capped_depth(events_from):
    rows = [("2019-11-04 05:00:00", "purchase", i, "a", "x", 1.0, 1, "long") for i in range(25)]
    events = events_from(rows)
    heat = behaviour.weekday_hour_heatmap(as_facts(events))
    assert heat.count() == 2 * 168
    assert values(heat.filter("purchases > 0"), "slice", "event_weekday", "event_hour", "purchases") == [
        ("2019-11", "Monday", 5, 25), ("all", "Monday", 5, 25)]
    assert values(behaviour.session_depth(events), "slice", "depth", "sessions") == [("2019-11", 20, 1), ("all", 20, 1)]


def test_day_without_views_has_ratio_zero(events_from):
    got = behaviour.daily_view_purchase_ratio(as_facts(events_from([purchase("2019-11-01", 1.0, 1)])))
    assert {r.ratio for r in got.collect()} == {0.0}


def test_cube_gives_the_same_panels(spark):
    from conftest import SMALL
    from shopsight.operators.panels.common import build_cube
    from shopsight.sources.shop import shop_events

    facts = as_facts(shop_events(spark, SMALL))
    cube = build_cube(facts)
    for panel in (overview.daily_events, overview.funnel, overview.category_revenue_top, behaviour.cumulative_revenue):
        assert values(panel(facts), *panel(facts).columns) == values(panel(cube), *panel(facts).columns)


# Scores and metrics


def test_tier_boundaries(spark):
    scores = [-0.1, 0.0, 0.35, 0.350001, 0.6, 0.600001, 1.0, 1.1, None]
    df = spark.createDataFrame([(s,) for s in scores], "churn_score double")
    assert [r.churn_risk for r in scoring.with_risk(df).collect()] == [
        None, "Low", "Low", "Medium", "Medium", "High", "High", None, None]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 0.0), (1, 0.05), (1, 0.999)], "label int, score double")
    counts = {r.bin: r["count"] for r in metrics.score_histogram(df).collect()}
    assert len(counts) == 20 and (counts[0], counts[1], counts[19]) == (1, 1, 2)


def test_metrics_against_a_direct_count(spark):
    import random

    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(400)]
    rows += [(i % 2, 0.5) for i in range(200)]  # a third of the rows tie
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    got = metrics.binary_metrics(spark.createDataFrame(rows, "label int, score double")).first()
    assert got.auc_roc == pytest.approx(auc, abs=1e-6)
    tp = sum(1 for y, s in rows if s > 0.5 and y)
    assert got.recall == pytest.approx(tp / len(pos), abs=1e-6)
    assert got.precision == pytest.approx(tp / sum(1 for _, s in rows if s > 0.5), abs=1e-6)
    curve = metrics.roc_curve(spark.createDataFrame(rows, "label int, score double")).orderBy("threshold").collect()
    assert (curve[0].fpr, curve[0].tpr) == (1.0, 1.0)


def test_metrics_with_one_class(spark):
    got = metrics.binary_metrics(spark.createDataFrame([(0, 0.2), (0, 0.4)], "label int, score double")).first()
    assert (got.auc_roc, got.f1, got.accuracy) == (0.0, 0.0, 1.0)


def test_lookup_reports_unknown_users(spark):
    churned = scoring.with_risk(spark.createDataFrame([(1, 0.7)], "user_id long, churn_score double"))
    segments = spark.createDataFrame([(1, "Lost", 3, 1, 1, 1, 40, 2, 9.5)], "user_id long, segment string, rfm_score int, r_score int, f_score int, m_score int, recency int, frequency long, monetary double")
    recs = spark.createDataFrame([(1, r, f"c{r}", 1.0 / r, 0.5, 0.1) for r in range(1, 8)], "user_id long, rank int, category string, upsell_score double, opportunity double, affinity double")
    got = scoring.lookup_scores(spark.createDataFrame([(1,), (2,)], "user_id long"), churned, segments, recs, 3)
    assert values(got, "user_id", "churn_found", "churn_risk", "recommendations") == [
        (1, True, "High", "c1,c2,c3"), (2, False, None, "")]
    assert values(got, "user_id", "recency", "monetary") == [(1, 40, 9.5), (2, None, None)]
    items = scoring.lookup_upsell(spark.createDataFrame([(1,), (2,)], "user_id long"), recs, 2)
    assert values(items.fillna(0, ["rank"]), "user_id", "rank", "found", "category", "opportunity") == [
        (1, 1, True, "c1", 0.5), (1, 2, True, "c2", 0.5), (2, 0, False, None, None)]
