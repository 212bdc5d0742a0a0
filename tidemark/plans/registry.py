"""Every operator as a named query over the test tables: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, money
from tidemark.functions.text_values import value_class
from tidemark.operators import affinity, calendar, customers, forecast, inference, profile, reports
from tidemark.plans import cube_queries, nested_queries, order_queries, stream_queries, table_queries  # noqa: F401  they register their own
from tidemark.plans.register import QUERIES, query, retail_query  # noqa: F401
from tidemark.plans.tables import Retail, raw_table, supplier_addresses, testdata_tables
from tidemark.session import shared_dir
from tidemark.sources import loader
from tidemark.sources.csv_tables import read_raw_csv
from tidemark.sources.storage import read_table

# Parameters of the registered queries on the test tables.
CHANNEL = "1-URGENT"
STATE = "NATION_3"
MIN_CATEGORIES = 23
PRODUCT = 180
OTHER_PRODUCT = 572
TEST_START = "2001-04"
TYPED_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


# --- ingest -----------------------------------------------------------------


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _export_csv(df: DataFrame, path: str) -> str:
    """A CSV extract of a table, as an ERP would deliver it."""
    df.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(
        path,
        header=True,
        escape='"',
        quoteAll=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


@query("i1_read_raw_csv")
def _(spark, sf_dir):
    path = _export_csv(raw_table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/documents.csv")
    raw = read_raw_csv(spark, path)
    return raw.select(*[F.nullif(c, F.lit("")).alias(c) for c in raw.columns])


def _typed(spark, sf_dir, names):
    return inference.infer_folder_types(
        {t: _as_text(raw_table(spark, sf_dir, t)) for t in names}
    )


@query("i2_infer_types")
def _(spark, sf_dir):
    return _typed(spark, sf_dir, TYPED_TABLES).select(
        "table", "pos", "column", "type", "n_filled", "n_code", "max_int"
    )


def _coded_orders(spark, sf_dir):
    """Orders as text with a zero-padded key and day-first dates, which must stay text."""
    return raw_table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("order_code"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("day_first"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso_day"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("o_custkey") + 3_000_000_000).cast("string").alias("long_id"),
    )


@query("i2a_code_columns")
def _(spark, sf_dir):
    return inference.infer_column_types(_coded_orders(spark, sf_dir)).select(
        "column", "type", "n_filled", "n_code"
    )


@query("i2b_value_classes")
def _(spark, sf_dir):
    cells = _as_text(raw_table(spark, sf_dir, "events")).unpivot(
        [], ["event_id", "ts", "user_id", "event_type", "value", "props"], "column", "v"
    )
    return cells.groupBy("column", value_class(F.col("v")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("i2c_code_examples")
def _(spark, sf_dir):
    return inference.code_examples({"orders": _coded_orders(spark, sf_dir)})


@query("i3_ddl")
def _(spark, sf_dir):
    raw = {
        "orders": raw_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id"),
        "lineitem": raw_table(spark, sf_dir, "lineitem"),
        "customer": raw_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id"),
    }
    types = inference.infer_folder_types({t: _as_text(df) for t, df in raw.items()})
    return inference.ddl_for(types, loader.row_counts(raw))


@query("i2_exact_numbers")
def _(spark, sf_dir):
    """Prices with exponents load as exact numbers."""
    lines = raw_table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    raw = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.concat(cents.cast("string"), F.lit("e-2")).alias("price"),
        F.concat((cents / 10).cast("decimal(20,1)").cast("string"), F.lit("E+1")).alias("cents"),
    )
    typed = loader.apply_schema(raw, inference.spark_schema(inference.infer_column_types(raw)))
    return typed.groupBy("order_id").agg(F.sum("price").alias("price"), F.sum("cents").alias("cents"))


def _erp_folder(spark, sf_dir, names):
    """A folder of extracts: two keyed tables, one keyless, one whose id repeats."""
    lines = raw_table(spark, sf_dir, "lineitem")
    extracts = {
        "orders": raw_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id"),
        "customer": raw_table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id"),
        "order_lines": lines.select("l_orderkey", "l_linenumber", "l_quantity"),
        "broken": lines.select(F.col("l_orderkey").alias("id"), "l_quantity"),
    }
    folder = f"{shared_dir(spark)}/csv"
    for name in names:
        _export_csv(extracts[name], f"{folder}/{name}.csv")
    return folder


@query("i4_full_refresh")
def _(spark, sf_dir):
    folder = _erp_folder(spark, sf_dir, ["orders"])
    dest = f"{shared_dir(spark)}/tables"
    for _ in range(2):
        loader.load_folder(spark, folder, dest)
    return read_table(spark, f"{dest}/orders")


def _audited(spark, loads, tables):
    """What became of each load, and the rows each table then has."""
    audit = loader.load_audit(spark, loads).select("table", "rows", "status")
    return audit.join(loader.row_counts(tables), "table", "left")


@query("i4_schema_misfit")
def _(spark, sf_dir):
    """A later extract with a text cell in a number column, and one of a table that is not known, fail."""
    orders = raw_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")
    dest, first, later = f"{shared_dir(spark)}/tables", f"{shared_dir(spark)}/csv", f"{shared_dir(spark)}/csv"
    _export_csv(orders, f"{first}/orders.csv")
    loads = loader.load_folder(spark, first, dest)
    misfit = F.concat(F.lit("x"), F.col("o_custkey").cast("string"))
    _export_csv(orders.withColumn("o_custkey", misfit), f"{later}/orders.csv")
    _export_csv(raw_table(spark, sf_dir, "nation"), f"{later}/nation.csv")
    schemas = {"orders": loader.table_schema(spark, f"{dest}/orders")}
    loads += loader.load_folder(spark, later, dest, schemas)
    return _audited(spark, loads, {"orders": read_table(spark, f"{dest}/orders")})


@query("i5_append_repeated_key")
def _(spark, sf_dir):
    """Rows with new keys are appended, the same extract once more is refused."""
    orders = raw_table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")
    dest, loads = f"{shared_dir(spark)}/tables", []
    for part in ("id % 2 = 0", "id % 2 = 1", "id % 2 = 1"):
        folder = f"{shared_dir(spark)}/csv"
        _export_csv(orders.where(part), f"{folder}/orders.csv")
        loads += loader.load_folder(spark, folder, dest, mode="append")
    return _audited(spark, loads, {"orders": read_table(spark, f"{dest}/orders")})


@query("i6_append_type_change")
def _(spark, sf_dir):
    """A keyless table keeps its types: an extract whose numbers turn to text is refused, the table stays readable."""
    lines = raw_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    changed = lines.withColumn("l_quantity", F.concat(F.lit("n/a "), F.col("l_quantity").cast("string")))
    dest, loads = f"{shared_dir(spark)}/tables", []
    for part in (lines, changed, lines):
        folder = f"{shared_dir(spark)}/csv"
        _export_csv(part, f"{folder}/lines.csv")
        loads += loader.load_folder(spark, folder, dest, mode="append")
    return _audited(spark, loads, {"lines": read_table(spark, f"{dest}/lines")})


@query("i5_key_violations")
def _(spark, sf_dir):
    parts = [
        loader.key_violations(raw_table(spark, sf_dir, t), keys).agg(
            F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
        ).select(F.lit(t).alias("table"), "n_keys", "n_rows")
        for t, keys in [("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey"])]
    ]
    return parts[0].unionAll(parts[1])


@query("i6_append_reload")
def _(spark, sf_dir):
    folder = _erp_folder(spark, sf_dir, ["order_lines"])
    dest = f"{shared_dir(spark)}/tables"
    for _ in range(2):
        loader.load_folder(spark, folder, dest, mode="append")
    return read_table(spark, f"{dest}/order_lines").groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")
    )


@query("i7_load_audit")
def _(spark, sf_dir):
    folder = _erp_folder(spark, sf_dir, ["orders", "customer", "order_lines", "broken"])
    results = loader.load_folder(spark, folder, f"{shared_dir(spark)}/tables")
    return loader.load_audit(spark, results).select("table", "rows", "status")


@query("i7_load_summary")
def _(spark, sf_dir):
    folder = _erp_folder(spark, sf_dir, ["orders", "customer", "order_lines", "broken"])
    results = loader.load_folder(spark, folder, f"{shared_dir(spark)}/tables")
    return loader.load_summary(loader.load_audit(spark, results))


@query("i8_row_counts")
def _(spark, sf_dir):
    return loader.row_counts({t: raw_table(spark, sf_dir, t) for t in TYPED_TABLES})


@query("i8_reconciliation")
def _(spark, sf_dir):
    names = ["customer", "orders", "lineitem", "events"]
    return loader.reconciliation_total({t: raw_table(spark, sf_dir, t) for t in names})


# --- profile ----------------------------------------------------------------


@retail_query("e1_order_summary")
def _(t):
    return profile.order_summary(t.orders)


@query("e2_shape")
def _(spark, sf_dir):
    return profile.table_shape(raw_table(spark, sf_dir, "orders"))


@query("e3_text_dates")
def _(spark, sf_dir):
    return profile.text_date_range(_as_text(raw_table(spark, sf_dir, "orders")), "o_orderdate")


@retail_query("e4_describe")
def _(t):
    d = profile.describe(t.orders, "total")
    return d.withColumns({c: F.round(c, 6) for c in ["std", "q25", "q50", "q75"]})


@retail_query("e5_preview")
def _(t):
    return profile.preview(t.orders, ["id"])


@retail_query("e6_median")
def _(t):
    return profile.median(t.orders, "total").withColumn("median", F.round("median", 6))


@query("e7_iqr_outliers")
def _(spark, sf_dir):
    out = profile.iqr_outliers(raw_table(spark, sf_dir, "events"), "value")
    return out.withColumns({c: F.round(c, 6) for c in ["lower_fence", "upper_fence"]})


@query("e8_duplicate_keys")
def _(spark, sf_dir):
    parts = [
        profile.duplicate_count(raw_table(spark, sf_dir, t), keys).select(F.lit(t).alias("table"), "*")
        for t, keys in [("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"])]
    ]
    return parts[0].unionAll(parts[1])


@query("e8_duplicate_rows")
def _(spark, sf_dir):
    return profile.duplicate_count(raw_table(spark, sf_dir, "lineitem"))


@retail_query("e9_line_total_mismatches")
def _(t):
    return profile.line_total_mismatches(t.orders, t.order_items)


@query("e9_amount_mismatches")
def _(spark, sf_dir):
    lines = raw_table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").cast(money.MONEY).alias("subtotal"),
        (F.col("l_extendedprice").cast(money.MONEY) * F.col("l_discount").cast("decimal(4,2)"))
        .cast(money.MONEY).alias("discount_amount"),
        (F.col("l_extendedprice").cast(money.MONEY) * (1 - F.col("l_discount").cast("decimal(4,2)")))
        .cast(money.MONEY).alias("total"),
    )
    return profile.amount_mismatches(lines)


@query("e9_text_length_mismatches")
def _(spark, sf_dir):
    docs = raw_table(spark, sf_dir, "documents")
    return profile.inconsistent_rows(docs, F.length("text").cast("bigint"), F.col("n_chars"))


def _labelled(spark, sf_dir):
    docs = raw_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return docs.join(raw_table(spark, sf_dir, "labels"), "doc_id", "left")


@query("e10_null_profile")
def _(spark, sf_dir):
    return profile.null_profile(_labelled(spark, sf_dir))


@query("e11_null_by_group")
def _(spark, sf_dir):
    return profile.null_by_group(_labelled(spark, sf_dir), "quality", "source")


@retail_query("e12_repeated_names")
def _(t):
    return profile.repeated_names(t.products)


@query("e12_placeholder_records")
def _(spark, sf_dir):
    events = raw_table(spark, sf_dir, "events").withColumn("name", F.concat(F.lit(" "), F.upper("event_type")))
    return profile.placeholder_records(events, ["name"], ["error", "asdf"]).select("event_id", "name")


# --- customers --------------------------------------------------------------


def _metrics(t: Retail) -> DataFrame:
    return customers.customer_metrics(
        customers.customer_sales(t.orders),
        customers.customer_diversity(t.orders, t.order_items, t.product_variants, t.products),
    )


def _elite(t: Retail) -> DataFrame:
    return customers.elite(_metrics(t), MIN_CATEGORIES)


def _elite_categories(t: Retail, k) -> DataFrame:
    return customers.group_categories(
        _elite(t), t.orders, t.order_items, t.product_variants, t.products, t.categories, k
    )


@retail_query("c1_customer_sales")
def _(t):
    return customers.customer_sales(t.orders)


@retail_query("c1_customer_sales_by_status")
def _(t):
    return customers.customer_sales(t.orders, statuses=["F", "O"], unique_orders=False)


@retail_query("c2_customer_diversity")
def _(t):
    return customers.customer_diversity(t.orders, t.order_items, t.product_variants, t.products)


@retail_query("c3_customer_metrics")
def _(t):
    return _metrics(t).withColumn("ticket", F.round("ticket", 2))


@retail_query("c4_elite_customers")
def _(t):
    return customers.elite_customers(_metrics(t), MIN_CATEGORIES)


@retail_query("c5_elite_top_category")
def _(t):
    return _elite_categories(t, 1)


@retail_query("c5c_elite_category_ranking")
def _(t):
    return _elite_categories(t, None)


@retail_query("c6_ticket_range")
def _(t):
    return customers.ticket_range(customers.elite_customers(_metrics(t), MIN_CATEGORIES))


# --- calendar ---------------------------------------------------------------


@retail_query("k1_calendar")
def _(t):
    return calendar.calendar(t.orders)


@retail_query("k2_daily_sales")
def _(t):
    return calendar.daily_sales(t.orders, CHANNEL)


@retail_query("k3_calendar_sales")
def _(t):
    return calendar.calendar_sales(t.orders, CHANNEL)


@retail_query("k3_weekday_mean")
def _(t):
    return calendar.weekday_mean(t.orders, CHANNEL).select("isodow", "weekday", "mean_sales")


@retail_query("k4_weekday_extremes")
def _(t):
    return calendar.weekday_extremes(calendar.weekday_mean(t.orders, CHANNEL))


@retail_query("k5_naive_mean")
def _(t):
    return calendar.weekday_mean(t.orders, CHANNEL)


# --- forecast ---------------------------------------------------------------


def _demand(t: Retail) -> DataFrame:
    return forecast.monthly_demand(t.orders, t.order_items, t.product_variants)


@retail_query("f1_product_lines")
def _(t):
    return forecast.product_lines(t.orders, t.order_items, t.product_variants, PRODUCT)


@retail_query("f2_monthly_demand")
def _(t):
    return _demand(t)


@retail_query("f2_product_monthly_demand")
def _(t):
    return forecast.monthly_demand(t.orders, t.order_items, t.product_variants, PRODUCT)


@retail_query("f3_filled_months")
def _(t):
    return forecast.fill_months(_demand(t))


@retail_query("f4_forecast")
def _(t):
    return forecast.forecast_ma(_demand(t), TEST_START).select("product_id", "month", "predicted")


@retail_query("f4_forecast_even_window")
def _(t):
    return forecast.forecast_ma(_demand(t), TEST_START, k=2, horizon=2).select(
        "product_id", "month", "predicted"
    )


@retail_query("f5_forecast_actual")
def _(t):
    return forecast.forecast_ma(_demand(t), TEST_START)


@retail_query("f6_forecast_error")
def _(t):
    return forecast.forecast_error(forecast.forecast_ma(_demand(t), TEST_START))


@retail_query("f7_product_by_name")
def _(t):
    return forecast.product_by_name(t.products, t.product_variants, t.order_items)


# --- affinity ---------------------------------------------------------------


def _inter(t: Retail) -> DataFrame:
    return affinity.interactions(t.orders, t.order_items, t.product_variants)


@retail_query("r1_interactions")
def _(t):
    return _inter(t)


@retail_query("r3_item_similarity")
def _(t):
    return affinity.item_similarity(_inter(t))


@retail_query("r3_item_similarity_blocks")
def _(t):
    return affinity.item_similarity(_inter(t), hot_basket=30)


@retail_query("r4_similar_products")
def _(t):
    return affinity.similar_products(_inter(t), PRODUCT)


@retail_query("r4b_top_similar")
def _(t):
    return affinity.top_similar_products(_inter(t))


@retail_query("r4b_top_similar_from_pairs")
def _(t):
    """The same list from the similarities of all pairs."""
    return affinity.top_similar(affinity.item_similarity(_inter(t)))


@retail_query("r5_named_similar")
def _(t):
    return affinity.named_similar(affinity.similar_products(_inter(t), PRODUCT), t.products)


@retail_query("r6_pair_overlap")
def _(t):
    return affinity.pair_overlap(_inter(t), PRODUCT, OTHER_PRODUCT)


@retail_query("r7_matrix_density")
def _(t):
    return affinity.matrix_density(_inter(t))


# --- reports ----------------------------------------------------------------


@retail_query("b1_kpis")
def _(t):
    return reports.kpis(t.orders, t.customers)


@retail_query("b2_revenue_by_state")
def _(t):
    return reports.revenue_by_state(t.orders, t.addresses).select("state", "revenue")


@retail_query("b2b_state_orders_customers")
def _(t):
    return reports.revenue_by_state(t.orders, t.addresses, k=None)


@query("b2_several_addresses")
def _(spark, sf_dir):
    t = testdata_tables(spark, sf_dir)
    doubled = supplier_addresses(spark, sf_dir).withColumn("is_primary", F.lit(True))
    return reports.revenue_by_state(t.orders, doubled, k=None)


@query("b2_primary_address_audit")
def _(spark, sf_dir):
    t = testdata_tables(spark, sf_dir)
    low = supplier_addresses(spark, sf_dir).withColumn("is_primary", F.col("state") < 2)
    return reports.primary_address_audit(t.customers, low)


@retail_query("b3_anchor_customers")
def _(t):
    return reports.anchor_customers(t.orders, t.addresses, t.customers)


@retail_query("b3b_anchor_customers_ties")
def _(t):
    return reports.anchor_customers(t.orders, t.addresses, t.customers, k=None, ties=True)


@retail_query("b3b_anchor_customers_ties_top")
def _(t):
    return reports.anchor_customers(t.orders, t.addresses, t.customers, k=5, ties=True)


def _top_products(t: Retail) -> DataFrame:
    return reports.top_products(t.order_items, t.product_variants, t.products)


def _state_products(t: Retail) -> DataFrame:
    return reports.top_products(
        t.order_items, t.product_variants, t.products, t.orders, t.addresses, STATE, k=5
    )


@retail_query("b4_top_products")
def _(t):
    return _top_products(t).select("product_id", "name", "units")


@retail_query("b4b_top_products_revenue")
def _(t):
    return _top_products(t)


@retail_query("b5_ranking_spread")
def _(t):
    return reports.ranking_spread(_top_products(t))


def _multi_state(spark, sf_dir) -> DataFrame:
    t = testdata_tables(spark, sf_dir)
    return reports.multi_state_customers(t.orders, supplier_addresses(spark, sf_dir), t.customers)


@query("b6_multi_state_customers")
def _(spark, sf_dir):
    return _multi_state(spark, sf_dir)


@retail_query("b7_state_products")
def _(t):
    return _state_products(t)


@retail_query("b8_ticket_by_state")
def _(t):
    return reports.ticket_by_state(t.orders, t.addresses)


@retail_query("b8_ticket_by_state_all")
def _(t):
    return reports.ticket_by_state(t.orders, t.addresses, k=None)


@retail_query("b9_common_products_top")
def _(t):
    return reports.common_products(_top_products(t), _state_products(t))


@retail_query("b9_common_products")
def _(t):
    return reports.common_products(
        reports.top_products(t.order_items, t.product_variants, t.products, k=200),
        reports.top_products(
            t.order_items, t.product_variants, t.products, t.orders, t.addresses, STATE, k=200
        ),
    )


@query("b10_leads_overall")
def _(spark, sf_dir):
    t = testdata_tables(spark, sf_dir)
    return reports.leads_overall(_multi_state(spark, sf_dir), customers.customer_sales(t.orders))


@retail_query("b11_kpi_texts")
def _(t):
    return reports.kpi_texts(reports.kpis(t.orders, t.customers))


@retail_query("b11_month_labels")
def _(t):
    month = dates.month_start(F.col("created_at"))
    return (
        t.orders.groupBy(dates.month_label(month).alias("month"))
        .agg(F.sum("total").alias("total"))
        .select("month", money.money_br(F.col("total")).alias("revenue"))
    )
