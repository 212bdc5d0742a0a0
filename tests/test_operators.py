"""Operators on edge rows written by hand, and properties that must hold."""

import itertools
import math
from datetime import date, datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import money
from tidemark.operators import affinity, calendar, customers, forecast, profile, quantiles, reports

ORDERS = "id int, customer_id int, total decimal(18,2), created_at timestamp_ntz, channel string, status string"
ITEMS = "order_id int, product_variant_id int, quantity int, line_total decimal(18,2)"


def orders(spark, rows):
    """(id, customer, total[, day, channel, status])"""
    full = []
    for r in rows:
        r = list(r) + [date(2024, 1, 1), "pos", "paid"][len(r) - 3:]
        full.append((r[0], r[1], Decimal(str(r[2])), datetime.combine(r[3], datetime.min.time()), r[4], r[5]))
    return spark.createDataFrame(full, ORDERS)


def items(spark, rows):
    return spark.createDataFrame([(*r, Decimal(r[2])) for r in rows], ITEMS)


def identity_variants(spark, ids):
    # Variants 100 + id, so that the hop from variant to product matters.
    return spark.createDataFrame([(100 + i, i) for i in ids], "id int, product_id int")


# --- quantiles and profile ----------------------------------------------------


@pytest.mark.parametrize("accuracy,hold", [(10_000, 4096), (50, 8), (10, 1)])
def test_quantiles_are_exact(spark, accuracy, hold):
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.lognormal(8, 4, 300), np.full(200, 7.0), [1e14, -5.0, 0.0]])
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,), (float("nan"),)], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = quantiles.quantile_values(df, "x", probs, accuracy, hold)
    assert [got[p] for p in probs] == pytest.approx(list(np.quantile(data, probs)), rel=1e-12)


def test_quantiles_of_extreme_values_need_few_passes(spark, monkeypatch):
    inf, passes = float("inf"), []
    narrowed = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: passes.append(1) or narrowed(*a))
    rows = [-inf, -1.5e308, -1.0, 0.0, 1.5e308, inf, inf] * 400 + [float(x) for x in range(3000)]
    df = spark.createDataFrame([(x,) for x in rows], "x double")
    got = quantiles.quantile_values(df, "x", [0.0, 0.1, 0.5, 0.9, 1.0], hold=16)
    data = sorted(rows)
    spot = {p: p * (len(data) - 1) for p in got}
    low = {p: data[math.floor(x)] for p, x in spot.items()}
    high = {p: data[math.ceil(x)] for p, x in spot.items()}
    assert got == {p: low[p] if low[p] == high[p] else low[p] + (high[p] - low[p]) * (x % 1) for p, x in spot.items()}
    assert len(passes) <= 4
    five = spark.createDataFrame([(x,) for x in (-1.5e308, 1.5e308, inf, -inf, 0.0)], "x double")
    assert quantiles.quantile_values(five, "x", [0.25, 0.5]) == {0.25: -1.5e308, 0.5: 0.0}


def test_profile_edges(spark):
    empty = spark.createDataFrame([], "x double")
    assert profile.median(empty, "x").first()[0] is None
    assert profile.describe(empty, "x").first()["n"] == 0
    assert profile.iqr_outliers(empty, "x").first()["n_high"] == 0
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100, -90]] + [(None,)], "x double")
    out = profile.iqr_outliers(df, "x").first()
    assert (out["n"], out["n_low"], out["n_high"]) == (6, 1, 1)
    assert tuple(profile.duplicate_count(spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")).first()) == (4, 2, 1, 2)
    named = spark.createDataFrame([(1, " ASDF"), (2, "asdf"), (3, "bolt"), (4, "bolt")], "id int, name string")
    assert {r.id for r in profile.placeholder_records(named, ["name"]).collect()} == {1, 2}
    assert {(r.id, r.n_ids) for r in profile.repeated_names(named).collect()} == {(3, 2), (4, 2)}
    amounts = spark.createDataFrame(
        [(Decimal("10.00"), Decimal("0.30"), Decimal("9.70")), (Decimal("10.00"), Decimal("0.30"), Decimal("9.71"))],
        "subtotal decimal(18,2), discount_amount decimal(18,2), total decimal(18,2)",
    )
    assert tuple(profile.amount_mismatches(amounts).first()) == (2, 1)


# --- customers ------------------------------------------------------------------


def test_elite_border_and_rounded_ties(spark):
    metrics = spark.createDataFrame(
        [(9, 3, 13, Decimal("10.004")), (1, 3, 13, Decimal("10.001")), (2, 3, 12, Decimal("99")),
         (4, 3, 14, Decimal("20")), (3, 3, 14, Decimal("20"))],
        "customer_id int, frequency int, diversity int, ticket decimal(18,3)",
    )
    best = customers.elite_customers(metrics, 13, 4).collect()
    assert [r.customer_id for r in best] == [3, 4, 9, 1]
    assert str(best[2].ticket) == str(best[3].ticket) == "10.00"


def test_customer_chain(spark):
    o = orders(spark, [(1, 1, 10), (2, 1, 20, date(2024, 1, 2), "web", "draft"), (3, 2, 5)])
    i = items(spark, [(1, 101, 3), (1, 102, 1), (2, 103, 4), (3, 101, 2), (3, 999, 9)])
    v = identity_variants(spark, [1, 2, 3])
    p = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "id int, category_id int")
    c = spark.createDataFrame([(7, "ropes"), (8, "motors")], "id int, name string")
    sales = customers.customer_sales(o)
    assert {(r.customer_id, str(r.revenue), r.frequency) for r in sales.collect()} == {(1, "30.00", 2), (2, "5.00", 1)}
    paid = customers.customer_sales(o, statuses=["paid"], unique_orders=False)
    assert {(r.customer_id, r.frequency) for r in paid.collect()} == {(1, 1), (2, 1)}
    diversity = customers.customer_diversity(o, i, v, p)
    assert {tuple(r) for r in diversity.collect()} == {(1, 2), (2, 1)}
    metrics = customers.customer_metrics(sales, diversity)
    group = customers.elite(metrics, 1, 2)
    ranked = customers.group_categories(group, o, i, v, p, c, k=None).collect()
    assert [tuple(r) for r in ranked] == [(7, "ropes", 6), (8, "motors", 4)]


# --- calendar -------------------------------------------------------------------


def test_calendar_counts_empty_days(spark):
    # Monday 1 January is only sold on the web; no Sunday at all; two weeks.
    o = orders(spark, [
        (1, 1, 50, date(2024, 1, 1), "web"), (2, 1, 10, date(2024, 1, 2), "pos"),
        (3, 1, 20, date(2024, 1, 8), "pos"), (4, 1, 30, date(2024, 1, 14), "web"),
    ])
    days = calendar.calendar(o)
    assert days.count() == 14
    joined = days.join(calendar.daily_sales(o, "pos"), "day", "left").select("day", "isodow", "weekday", "sales")
    assert sorted(calendar.calendar_sales(o, "pos").collect()) == sorted(joined.collect())
    means = {r.isodow: r for r in calendar.weekday_mean(o, "pos").collect()}
    assert (str(means[1].mean_sales), str(means[1].naive_mean)) == ("10.00", "20.00")
    assert (str(means[7].mean_sales), means[7].naive_mean, means[7].n_days) == ("0.00", None, 2)
    assert all(r.naive_mean is None or r.mean_sales <= r.naive_mean for r in means.values())
    ends = calendar.weekday_extremes(calendar.weekday_mean(o, "pos")).first()
    assert (ends.worst_day, ends.best_day) == ("Quarta-feira", "Segunda-feira")
    none = orders(spark, [])
    assert calendar.calendar(none).count() == calendar.weekday_mean(none, "pos").count() == 0


# --- forecast ---------------------------------------------------------------------


def demand(spark, series):
    rows = [(p, date(2025 + (m - 1) // 12, (m - 1) % 12 + 1, 1), u) for p, s in series.items() for m, u in s.items()]
    return spark.createDataFrame(rows, "product_id int, month date, units bigint")


def test_month_gaps(spark):
    filled = forecast.fill_months(demand(spark, {1: {1: 5, 4: 6, 12: 7}, 2: {3: 1}})).orderBy("product_id", "month")
    rows = filled.collect()
    assert [r.units for r in rows if r.product_id == 1] == [5, 0, 0, 6, 0, 0, 0, 0, 0, 0, 0, 7]
    assert [r.units for r in rows if r.product_id == 2] == [1]


def reference_forecast(series, start, k, horizon):
    values = dict(series)
    for m in range(start, start + horizon):
        values[m] = round(sum(values.get(x, 0) for x in range(m - k, m)) / k)
    return [values[m] for m in range(start, start + horizon)]


def test_forecast(spark):
    series = {
        1: {9: 30, 10: 20, 12: 25, 13: 69, 14: 42, 15: 45, 16: 9},
        2: {9: 30, 10: 20, 12: 25, 13: 1, 15: 2},  # same past, other test months
        3: {10: 5, 12: 1},  # ends before the test
        4: {12: 5, 15: 5},  # begins inside the window
        5: {10: 2, 11: 2, 12: 3, 15: 4},
    }
    d = demand(spark, series)
    rows = forecast.forecast_ma(d, "2026-01").orderBy("product_id", "month").collect()
    assert sorted({r.product_id for r in rows}) == [1, 2, 5]
    for p in (1, 2, 5):
        mine = [r for r in rows if r.product_id == p]
        assert [r.month for r in mine] == ["2026-01", "2026-02", "2026-03"]
        assert [r.predicted for r in mine] == reference_forecast(series[p], 13, 3, 3)
        assert [r.actual for r in mine] == [series[p].get(m, 0) for m in (13, 14, 15)]
    assert [r.predicted for r in rows if r.product_id == 1] == [r.predicted for r in rows if r.product_id == 2]
    even = forecast.forecast_ma(d, "2026-01", k=2, horizon=2).where("product_id = 5").orderBy("month").collect()
    assert [r.predicted for r in even] == reference_forecast(series[5], 13, 2, 2) == [2, 2]
    error = {r.product_id: r for r in forecast.forecast_error(forecast.forecast_ma(d, "2026-01")).collect()}
    one = error[1]
    predicted = reference_forecast(series[1], 13, 3, 3)
    assert one.mae == pytest.approx(sum(abs(a - b) for a, b in zip(predicted, [69, 42, 45])) / 3)
    assert one.mean_units == pytest.approx(sum(series[1].values()) / 8)
    assert one.mean_before == pytest.approx(75 / 4)


def test_product_by_name(spark):
    p = spark.createDataFrame([(74, "compass"), (240, "compass"), (5, "rope")], "id int, name string")
    v = spark.createDataFrame([(1, 74), (2, 74), (3, 240)], "id int, product_id int")
    i = items(spark, [(1, 1, 1), (1, 2, 1), (2, 3, 9)])
    assert [tuple(r) for r in forecast.product_by_name(p, v, i, "compass").collect()] == [("compass", 74, 2, 2)]
    assert [tuple(r) for r in forecast.product_by_name(p, v, i, "rope").collect()] == [("rope", 5, 0, 1)]


# --- affinity ----------------------------------------------------------------------


def brute_force(pairs):
    buyers = {}
    for c, p in pairs:
        buyers.setdefault(p, set()).add(c)
    out = {}
    for a, b in itertools.combinations(sorted(buyers), 2):
        both = len(buyers[a] & buyers[b])
        if both:
            out[a, b] = (both, both / (math.sqrt(len(buyers[a])) * math.sqrt(len(buyers[b]))))
    return buyers, out


@pytest.fixture(scope="module")
def skewed_pairs():
    # One customer bought everything, one product was bought by all.
    rng = np.random.default_rng(5)
    pairs = {(c, int(p)) for c in range(40) for p in rng.integers(0, 60, 6)}
    pairs |= {(0, p) for p in range(60)} | {(1, p) for p in range(0, 60, 2)} | {(c, 7) for c in range(40)}
    return sorted(pairs)


@pytest.mark.parametrize("hot,chunk", [(256, 512), (5, 16), (0, 7), (3, 1)])
def test_similarity_of_hot_baskets(spark, skewed_pairs, hot, chunk):
    inter = spark.createDataFrame(skewed_pairs, "customer_id int, product_id int")
    buyers, expected = brute_force(skewed_pairs)
    found = affinity.co_purchases(inter, hot, chunk).collect()
    assert {(r.product_a, r.product_b): r.co for r in found} == {k: v[0] for k, v in expected.items()}
    assert all(r.buyers_a == len(buyers[r.product_a]) and r.buyers_b == len(buyers[r.product_b]) for r in found)


def test_similarity_rankings(spark, skewed_pairs):
    inter = spark.createDataFrame(skewed_pairs, "customer_id int, product_id int")
    buyers, expected = brute_force(skewed_pairs)
    sims = affinity.item_similarity(inter, hot_basket=10)
    found = {(r.product_a, r.product_b): r.similarity for r in sims.collect()}
    assert found == pytest.approx({k: v[1] for k, v in expected.items()})
    assert all(0 < s <= 1 + 1e-12 for s in found.values())

    def ranking(p, k):
        scores = {q: expected.get((min(p, q), max(p, q)), (0, 0.0))[1] for q in buyers if q != p}
        return sorted(scores, key=lambda q: (-round(scores[q], 12), q))[:k]

    top = affinity.top_similar(sims, 5).collect()
    for p in buyers:
        assert [r.similar_id for r in sorted(top, key=lambda r: r.position) if r.product_id == p] == ranking(p, 5)
    for p in (0, 7, 33):
        assert [r.product_id for r in affinity.similar_products(inter, p, 5).collect()] == ranking(p, 5)
    pair = affinity.pair_overlap(inter, 3, 7).first()
    assert (pair.buyers_a, pair.buyers_b, pair.both) == (len(buyers[3]), len(buyers[7]), len(buyers[3] & buyers[7]))
    assert pair.similarity == pytest.approx(found[3, 7])
    size = affinity.matrix_density(inter).first()
    assert (size.n_customers, size.n_products, size.n_interactions) == (40, 60, len(skewed_pairs))


def test_products_without_common_buyer(spark):
    inter = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (2, 4)], "customer_id int, product_id int")
    assert [(r.product_id, r.similarity) for r in affinity.similar_products(inter, 1, 5).collect()] == [
        (2, 1.0), (3, 0.0), (4, 0.0)
    ]
    assert affinity.similar_products(inter, 99, 5).count() == 0
    assert {(r.product_a, r.product_b) for r in affinity.item_similarity(inter).collect()} == {(1, 2), (3, 4)}
    names = spark.createDataFrame([(2, "b", 1), (3, "c", 1), (4, "d", 2)], "id int, name string, category_id int")
    named = affinity.named_similar(affinity.similar_products(inter, 1, 5), names).collect()
    assert [r.name for r in named] == ["b", "c", "d"]


def test_interactions_hop_over_variants(spark):
    o = orders(spark, [(1, 1, 1), (2, 1, 1), (3, 2, 1)])
    i = items(spark, [(1, 11, 1), (2, 12, 5), (3, 11, 1), (9, 11, 1)])
    v = spark.createDataFrame([(11, 1), (12, 1)], "id int, product_id int")
    assert sorted(tuple(r) for r in affinity.interactions(o, i, v).collect()) == [(1, 1), (2, 1)]


# --- reports -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def shop(spark):
    o = orders(spark, [(1, 1, 10), (2, 1, 20), (3, 2, 30), (4, 3, 99), (5, 4, 5)])
    a = spark.createDataFrame(
        [(1, "AL", True), (1, "SP", False), (2, "AL", True), (4, "AL", True), (4, "AL", True), (4, "SP", True)],
        "customer_id int, state string, is_primary boolean",
    )
    c = spark.createDataFrame([(i, f"c{i}") for i in range(1, 6)], "id int, legal_name string")
    return o, a, c


def test_state_reports(spark, shop):
    o, a, c = shop
    # Customer 4 has three primary addresses, customer 3 none.
    states = {r.state: r for r in reports.revenue_by_state(o, a, k=None).collect()}
    assert {s: (str(r.revenue), r.n_orders, r.n_customers) for s, r in states.items()} == {
        "AL": ("70.00", 4, 3), "SP": ("5.00", 1, 1)
    }
    tickets = {r.state: (r.n_orders, str(r.mean_ticket)) for r in reports.ticket_by_state(o, a).collect()}
    assert tickets == {"AL": (5, "14.00"), "SP": (1, "5.00")}
    assert tuple(reports.primary_address_audit(c, a).first()) == (5, 2, 2, 1)
    one = reports.anchor_customers(o, a, c).collect()
    assert [(r.state, r.customer_id) for r in one] == [("AL", 1), ("SP", 4)]
    tied = reports.anchor_customers(o, a, c, ties=True).collect()
    assert [(r.state, r.customer_id) for r in tied] == [("AL", 1), ("AL", 2), ("SP", 4)]
    several = reports.multi_state_customers(o, a, c)
    assert [(r.customer_id, r.n_states, str(r.spent)) for r in several.collect()] == [(1, 2, "30.00"), (4, 2, "5.00")]
    lead = reports.leads_overall(several, customers.customer_sales(o)).first()
    assert tuple(lead) == (1, 3, False)


def test_means_are_rounded_once(spark):
    # 20 001 orders of 1.00 or 1.01 with a true mean of 1.00499975: a quotient cut to six places first would give 1.01.
    many = spark.range(20_001).select(
        F.col("id").cast("int").alias("id"), F.lit(1).alias("customer_id"),
        F.when(F.col("id") < 10_000, "1.01").otherwise("1.00").cast("decimal(18,2)").alias("total"),
    )
    cents = [(101, 10_000), (100, 10_001)]
    exact = Decimal(sum(c * n for c, n in cents)) / sum(n for _, n in cents) / 100
    assert exact < Decimal("1.005")
    places = spark.createDataFrame([(1, "AL", True)], "customer_id int, state string, is_primary boolean")
    assert reports.ticket_by_state(many, places).first()["mean_ticket"] == Decimal("1.00")
    people = spark.createDataFrame([(1,)], "id int")
    assert reports.kpis(many, people).first()["mean_ticket"] == Decimal("1.00")
    sums = spark.createDataFrame([(Decimal("-0.05"), 10), (Decimal("0.05"), 10), (Decimal("1.00"), 0), (None, 3), (Decimal("99999999999999.99"), 1)], "t decimal(28,2), n int")
    got = [r[0] for r in sums.select(money.rounded_ratio(F.col("t"), F.col("n"))).collect()]
    assert got == [Decimal("-0.01"), Decimal("0.01"), None, None, Decimal("99999999999999.99")]


def test_ties_keep_whole_states(spark):
    sold = orders(spark, [(1, 1, 10), (2, 2, 10), (3, 3, 10), (4, 4, 9), (5, 5, 8)])
    places = spark.createDataFrame(
        [(1, "AL", True), (2, "AL", True), (3, "AL", True), (4, "SP", True), (5, "RJ", True)], "customer_id int, state string, is_primary boolean")
    people = spark.createDataFrame([(i, f"n{i}") for i in range(1, 6)], "id int, legal_name string")
    got = reports.anchor_customers(sold, places, people, k=2, ties=True).collect()
    assert [(r["state"], r["customer_id"]) for r in got] == [("AL", 1), ("AL", 2), ("AL", 3), ("SP", 4)]


def test_product_reports(spark, shop):
    o, a, _ = shop
    i = items(spark, [(1, 101, 3), (3, 102, 3), (4, 103, 50), (5, 102, 1)])
    v = identity_variants(spark, [1, 2, 3])
    p = spark.createDataFrame([(1, "asdf"), (2, "asdf"), (3, "rope")], "id int, name string")
    top = reports.top_products(i, v, p)
    assert [(r.product_id, r.units) for r in top.collect()] == [(3, 50), (2, 4), (1, 3)]
    local = reports.top_products(i, v, p, o, a, "AL", k=5)
    assert [(r.product_id, r.units) for r in local.collect()] == [(2, 5), (1, 3)]
    assert reports.ranking_spread(top).first()["spread_pct"] == pytest.approx(94.0)
    assert sorted(r[0] for r in reports.common_products(top, local).collect()) == [1, 2]


def test_empty_inputs(spark):
    o, i = orders(spark, []), items(spark, [])
    v = spark.createDataFrame([], "id int, product_id int")
    p = spark.createDataFrame([], "id int, name string, category_id int")
    c = spark.createDataFrame([], "id int, legal_name string")
    a = spark.createDataFrame([], "customer_id int, state string, is_primary boolean")
    inter = affinity.interactions(o, i, v)
    for df in [
        customers.customer_diversity(o, i, v, p), forecast.forecast_ma(forecast.monthly_demand(o, i, v), "2026-01"),
        affinity.item_similarity(inter), affinity.similar_products(inter, 1), reports.top_products(i, v, p),
        reports.revenue_by_state(o, a), reports.anchor_customers(o, a, c), reports.multi_state_customers(o, a, c),
    ]:
        assert df.count() == 0
    kpi = reports.kpis(o, c).first()
    assert (kpi.n_orders, kpi.mean_ticket, kpi.n_customers) == (0, None, 0)


def test_brazilian_text(spark):
    row = spark.sql("select cast(1234567.891 as double) as x, cast(1234.5 as decimal(18,2)) as y").select(
        money.number_br(F.col("x"), 1), money.money_br(F.col("y")), money.millions_br(F.col("x"))
    ).first()
    assert tuple(row) == ("1.234.567,9", "R$ 1.234,50", "R$ 1,2 mi")
