"""The registered queries: a Spark callable and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import schema
from demandloom.catalog.sql import (
    BRAND_BANDIT, DISTANCE, FACTS, PRODUCT_BANDIT, PROFILE, grid, lagged, stable, windowed, with_views,
)
from demandloom.catalog.views import SEED, Retail
from demandloom.functions import columns as cols
from demandloom.operators import allocate as alloc
from demandloom.operators import bandit, density, forecast, metrics, prepare, profile, quality, radius, sketches, timeline, tuning, weekly, windows
from demandloom.plans import weekly_plan
from demandloom.schema import CATEGORY, HORIZON, LAGS, MEASURES, PRODUCT, STORE, WINDOWED, numbered
from demandloom.session import cut, scratch_path
from demandloom.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Fixed parameters of the registered queries. The gate of 0.986 lets nothing pass on the sample tables.
THRESHOLD = 0.5


def query(name: str, sql: str | None = None):
    """Register ``fn(retail)`` under a name."""
    def register(fn: Callable[[Retail], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Retail(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def rounded(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def nearest(column: str | Column) -> Column:
    """Nearest float, as double."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("float").cast("double")


def steadied(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: nearest(n) for n in names})


# ---------------------------------------------------------------- sources, sinks, quality

TRANSACTION_COLUMNS = schema.TRANSACTIONS.fieldNames()


@query("scan_parquet", with_views(f"SELECT {', '.join(TRANSACTION_COLUMNS)}, premise, categoria_pdv, zipcode, descricao, categoria, subcategoria "
                                  "FROM sales JOIN active ON pdv = internal_store_id JOIN sku ON produto = internal_product_id"))
def scan_parquet(r: Retail):
    """The three tables written, scanned by their contracts, and joined so that every column shows."""
    paths = {n: scratch_path(r.spark, n) for n in ("sku", "transactions", "stores")}
    for n, path in paths.items():
        tables.write_parquet(getattr(r, n), path)
    sku, sales, stores = tables.scan_tables(r.spark, **paths)
    return sales.join(stores.withColumnRenamed("pdv", STORE), STORE).join(sku.withColumnRenamed("produto", PRODUCT), PRODUCT).select(
        *TRANSACTION_COLUMNS, "premise", CATEGORY, "zipcode", "descricao", "categoria", "subcategoria")


@query("parquet_roundtrip", with_views(
    f"SELECT {', '.join(TRANSACTION_COLUMNS)} FROM transactions"
))
def parquet_roundtrip(r: Retail):
    path = scratch_path(r.spark, "transactions")
    tables.write_parquet(r.transactions.select(*TRANSACTION_COLUMNS), path)
    return tables.read_transactions(r.spark, path)


@query("table_summary", with_views(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' column_name, COUNT({c}) n, COUNT(*) - COUNT({c}) nulls, {stable(f'AVG({c})', 'mean')}, {stable(f'STDDEV({c})', 'std')}, "
        f"round(CAST(MIN({c}) AS DOUBLE), 6) min, round(CAST(MAX({c}) AS DOUBLE), 6) max, "
        f"CAST(NULL AS VARCHAR) min_text, CAST(NULL AS VARCHAR) max_text FROM transactions"
        for c in (*MEASURES, "distributor_id")
    ) + " UNION ALL " + " UNION ALL ".join(
        f"SELECT '{c}', COUNT({c}), COUNT(*) - COUNT({c}), NULL, NULL, NULL, NULL, CAST(MIN({c}) AS VARCHAR), "
        f"CAST(MAX({c}) AS VARCHAR) FROM transactions"
        for c in (STORE, PRODUCT, "transaction_date", "reference_date")
    ) + ")"
))
def table_summary(r: Retail):
    """All columns; the approximate quartiles are left out of the comparison."""
    summary = quality.table_summary(r.transactions)
    return steadied(rounded(summary, ["min", "max"]), ["mean", "std"]).select(
        "column_name", "n", "nulls", "mean", "std", "min", "max", "min_text", "max_text")


@query("quartile_ranks", with_views(
    " UNION ALL ".join(f"SELECT '{m}' AS column_name, CAST({s} AS DOUBLE) AS share, COUNT({m}) AS n, TRUE AS within FROM transactions"
                       for m in MEASURES for s in sketches.QUARTILES)
))
def quartile_ranks(r: Retail):
    """Quartiles of all measures from sketches per month, held against exact ranks."""
    by_month = sketches.quantile_sketches(r.transactions, ["reference_date"], MEASURES)
    bounds = sketches.rank_bounds(r.transactions, sketches.merged_quantiles(by_month, [], MEASURES))
    return bounds.select("column_name", "share", "n", sketches.within_rank_error(bounds).alias("within"))


@query("sketch_rollup", with_views(
    "SELECT categoria_pdv, COUNT(DISTINCT internal_product_id) AS products, COUNT(DISTINCT distributor_id) AS distributors, "
    "TRUE AS products_within, TRUE AS distributors_within FROM sales JOIN stores ON pdv = internal_store_id GROUP BY 1"
))
def sketch_rollup(r: Retail):
    """Distinct products and distributors of a category, exact and from sketches per store and week."""
    columns = (PRODUCT, "distributor_id")
    weekly_sketches = sketches.distinct_sketches(r.positive, [STORE, cols.week_of(F.col("transaction_date")).alias("week")], columns)
    categories = r.stores.select(F.col("pdv").alias(STORE), CATEGORY)
    estimate = sketches.merged_distinct(weekly_sketches.join(categories, STORE), [CATEGORY], columns)
    exact = r.positive.join(categories, STORE).groupBy(CATEGORY).agg(
        F.count_distinct(PRODUCT).alias("products"), F.count_distinct("distributor_id").alias("distributors"))

    def near(guess: str, count: str) -> Column:
        return F.abs(F.col(guess) - F.col(count)) <= F.greatest(F.lit(1.0), sketches.DISTINCT_ERROR * F.col(count))

    return exact.join(estimate, CATEGORY).select(
        CATEGORY, "products", "distributors", near(PRODUCT, "products").alias("products_within"),
        near("distributor_id", "distributors").alias("distributors_within"))


@query("key_violations", with_views(
    "SELECT internal_store_id, internal_product_id, COUNT(*) AS rows FROM transactions GROUP BY 1, 2 HAVING COUNT(*) > 1"
))
def key_violations(r: Retail):
    return quality.key_violations(r.transactions, [STORE, PRODUCT])


# ---------------------------------------------------------------- projections and filters

@query("positive_transactions", with_views(f"SELECT {', '.join(TRANSACTION_COLUMNS)} FROM positive"))
def positive_transactions(r: Retail):
    return r.positive.select(*TRANSACTION_COLUMNS)


@query("sku_clean", with_views("SELECT produto, descricao, categoria FROM sku"))
def sku_clean(r: Retail):
    return prepare.clean_sku(r.sku)


ZIP_SQL = "CASE WHEN CAST(zipcode AS VARCHAR) = '8107' THEN '08107' ELSE CAST(zipcode AS VARCHAR) END"


@query("zip_clean", with_views(f"SELECT pdv, premise, categoria_pdv, {ZIP_SQL} AS zipcode FROM stores"))
def zip_clean(r: Retail):
    return prepare.with_clean_zip(r.stores)


@query("premise_flags", with_views(
    "SELECT pdv, CAST(premise = 'On Premise' AS INTEGER) AS is_on_premise, "
    "CAST(contains(premise, 'On') AS INTEGER) AS premise_contains_on FROM stores"
))
def premise_flags(r: Retail):
    return prepare.with_premise_flags(r.stores).select("pdv", "is_on_premise", "premise_contains_on")


@query("weekly_volume", with_views(
    f"SELECT wk AS week, COUNT(*) AS rows, {grid('SUM(quantity)', 'quantity')} FROM positive GROUP BY 1"
))
def weekly_volume(r: Retail):
    weeks = r.positive.groupBy(cols.week_of(F.col("transaction_date")).alias("week"))
    return weeks.agg(F.count("*").alias("rows"), F.round(F.sum("quantity"), 6).alias("quantity"))


# ---------------------------------------------------------------- joins

@query("active_stores", with_views("SELECT pdv, premise, categoria_pdv, zipcode FROM active"))
def active_stores(r: Retail):
    return r.active


@query("known_transactions", with_views(f"SELECT {', '.join(TRANSACTION_COLUMNS)} FROM sales"))
def known_transactions(r: Retail):
    return r.sales.select(*TRANSACTION_COLUMNS)


@query("transactions_enriched", with_views(
    "SELECT internal_store_id, internal_product_id, transaction_date, wk AS week, premise, categoria_pdv, zipcode, "
    "quantity, net_value FROM positive JOIN stores ON pdv = internal_store_id"
))
def transactions_enriched(r: Retail):
    return prepare.enrich(r.positive, r.stores).select(
        STORE, PRODUCT, "transaction_date", "week", "premise", CATEGORY, "zipcode", "quantity", "net_value"
    )


@query("store_product_shares", with_views(
    f"SELECT pdv, categoria_pdv, internal_product_id, {stable('share', 'share')} FROM stores JOIN shares USING (categoria_pdv)",
    BRAND_BANDIT,
))
def store_product_shares(r: Retail):
    return steadied(bandit.store_product_shares(r.brand_shares, r.stores), ["share"])


NAIVE_COLUMNS = ", ".join(f"quantity{LAGS + 1 + h:02d} AS column_{h}" for h in range(HORIZON))
NAIVE = f"naive AS (SELECT internal_store_id, {NAIVE_COLUMNS} FROM windows WHERE week = 52)"
HORIZON_LIST = ", ".join(f"column_{h}" for h in range(HORIZON))


@query("forecast_right_join", with_views(
    f"SELECT f.internal_store_id AS pdv, s.internal_product_id, {stable('s.share', 'share')}, {HORIZON_LIST} "
    "FROM (SELECT pdv, internal_product_id, share FROM stores JOIN shares USING (categoria_pdv)) s "
    "RIGHT JOIN naive f ON f.internal_store_id = s.pdv",
    FACTS, windowed(["quantity"]), NAIVE, BRAND_BANDIT,
))
def forecast_right_join(r: Retail):
    joined = alloc.right_join_forecasts(
        bandit.store_product_shares(r.brand_shares, r.stores).drop(CATEGORY), r.naive()
    )
    return steadied(joined, ["share"])


# ---------------------------------------------------------------- aggregations

SUMS = ", ".join(grid(m) for m in MEASURES)


@query("store_week_sum", with_views(
    f"SELECT internal_store_id, week, product_rows, product_diversity, {SUMS} FROM facts", FACTS
))
def store_week_sum(r: Retail):
    facts = weekly.store_weeks(r.sales).drop("most_bought_product")
    return rounded(facts, MEASURES)


MEANS = ", ".join(stable(f"AVG({m})", m) for m in MEASURES)
CATEGORY_MODE = """
category_products AS (
  SELECT categoria_pdv, wk, internal_product_id, row_number() OVER (
           PARTITION BY categoria_pdv, wk ORDER BY COUNT(*) DESC, internal_product_id) AS rn
  FROM sales JOIN active ON pdv = internal_store_id GROUP BY 1, 2, 3)
"""


@query("category_week_mean", with_views(
    f"SELECT categoria_pdv, wk AS week, COUNT(*) product_rows, COUNT(DISTINCT s.internal_product_id) product_diversity, "
    f"MAX(c.internal_product_id) most_bought_product, "
    f"CASE WHEN 2 * COUNT(*) FILTER (premise = 'On Premise') > COUNT(*) THEN 1 ELSE 0 END premise, {MEANS} "
    "FROM sales s JOIN active ON pdv = internal_store_id JOIN category_products c USING (categoria_pdv, wk) "
    "WHERE rn = 1 GROUP BY 1, 2",
    CATEGORY_MODE,
))
def category_week_mean(r: Retail):
    return steadied(weekly.weekly_facts(r.positive, r.stores, CATEGORY), MEASURES)


TOP = """
ranked AS (
  SELECT internal_store_id, wk AS week, internal_product_id, row_number() OVER (
           PARTITION BY internal_store_id, wk ORDER BY COUNT(*) DESC, internal_product_id) AS rn
  FROM sales GROUP BY 1, 2, 3),
top AS (SELECT internal_store_id, week, internal_product_id AS most_bought_product FROM ranked WHERE rn = 1)
"""


@query("top_product_week", with_views("SELECT * FROM top", TOP))
def top_product_week(r: Retail):
    return weekly.store_weeks(r.sales, ()).select(STORE, "week", "most_bought_product")


@query("top_product_store", with_views(
    "SELECT internal_store_id, most_bought_product FROM (SELECT internal_store_id, most_bought_product, row_number() OVER ("
    "PARTITION BY internal_store_id ORDER BY COUNT(*) DESC, most_bought_product) rn FROM top GROUP BY 1, 2) WHERE rn = 1",
    TOP,
))
def top_product_store(r: Retail):
    return weekly.usual_product(weekly.store_weeks(r.sales, ()))


@query("category_product_lists", with_views(
    "SELECT categoria_pdv, COUNT(*) AS size, string_agg(internal_product_id, ',' ORDER BY internal_product_id) AS products, "
    f"{stable('SUM(share)', 'total')} FROM shares GROUP BY 1",
    PRODUCT_BANDIT,
))
def category_product_lists(r: Retail):
    lists = bandit.category_lists(bandit.category_shares(bandit.draw(r.arms, SEED)))
    total = F.aggregate("scaled_prob", F.lit(0.0), lambda acc, v: acc + v)
    return lists.select(
        CATEGORY, F.size(PRODUCT).cast("long").alias("size"), F.array_join(PRODUCT, ",").alias("products"),
        nearest(total).alias("total"),
    )


@query("store_profile", with_views(
    f"SELECT pdv, zipcode, transaction_rows, {stable('quantity', 'quantity')}, {stable('net_value', 'net_value')}, "
    "distributor_count, transaction_count FROM profile", PROFILE,
))
def store_profile(r: Retail):
    return steadied(r.profile, ["quantity", "net_value"])


@query("store_profile_full", with_views(
    f"SELECT p.*, l.transacted_products FROM (SELECT pdv, {ZIP_SQL} AS zipcode, categoria_pdv, {MEANS}, "
    "COUNT(DISTINCT distributor_id) AS distributor_count, COUNT(*) AS transaction_count "
    "FROM active JOIN sales ON pdv = internal_store_id GROUP BY 1, 2, 3) p JOIN ("
    "SELECT internal_store_id, string_agg(internal_product_id || ':' || n, ',' ORDER BY internal_product_id) AS "
    "transacted_products FROM (SELECT internal_store_id, internal_product_id, COUNT(*) AS n FROM sales GROUP BY 1, 2) "
    "GROUP BY 1) l ON l.internal_store_id = p.pdv",
))
def store_profile_full(r: Retail):
    full = profile.store_profile_full(r.positive, r.stores)
    text = F.transform("transacted_products", lambda p: F.concat_ws(":", p["product"], p["rows"].cast("string")))
    return steadied(full, MEASURES).withColumn("transacted_products", F.array_join(text, ","))


@query("category_product_week_mean", with_views(
    f"SELECT categoria_pdv, internal_product_id, week, {stable('AVG(quantity)', 'quantity')} FROM ("
    "SELECT internal_store_id, wk AS week, internal_product_id, SUM(quantity) AS quantity FROM positive GROUP BY 1, 2, 3) "
    "JOIN stores ON pdv = internal_store_id GROUP BY 1, 2, 3"
))
def category_product_week_mean(r: Retail):
    return steadied(weekly.category_product_week_mean(r.positive, r.stores), ["quantity"])


# ---------------------------------------------------------------- calendar, windows, reshape

@query("weekly_facts", with_views(
    f"SELECT internal_store_id, week, product_rows, product_diversity, most_bought_product, {SUMS}, "
    "CAST(premise = 'On Premise' AS INTEGER) AS premise "
    "FROM facts JOIN top USING (internal_store_id, week) JOIN active ON pdv = internal_store_id", FACTS, TOP
))
def weekly_facts(r: Retail):
    return rounded(r.facts, MEASURES)


@query("store_week_sorted", with_views(
    f"SELECT internal_store_id, week, {grid('quantity')} FROM facts ORDER BY 1, 2", FACTS
))
def store_week_sorted(r: Retail):
    return rounded(weekly.sorted_facts(weekly.store_weeks(r.sales).select(STORE, "week", "quantity")), ["quantity"])


@query("dense_calendar", with_views(
    f"SELECT internal_store_id, week, {SUMS}, product_diversity FROM calendar", FACTS
))
def dense_calendar(r: Retail):
    return rounded(weekly.dense_calendar(weekly.store_weeks(r.sales)), MEASURES)


def of_weeks(arrays: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """The measures of every week changed; a week is in 13 windows of 40, so before these are formed."""
    names = arrays.schema["weeks"].dataType.elementType.fieldNames()
    return arrays.withColumn("weeks", F.transform("weeks", lambda w: F.struct(
        *[(change(w[n]) if n in WINDOWED else w[n]).alias(n) for n in names])))


@query("sliding_windows", with_views(
    "SELECT internal_store_id, week, " + ", ".join(" || ',' || ".join(
        f"CAST(CAST(round({m}{k:02d} * 1e6) AS BIGINT) AS VARCHAR)" for k in range(1, 14)) + f" AS {m}" for m in WINDOWED
    ) + " FROM windows", FACTS, windowed(WINDOWED),
))
def sliding_windows(r: Retail):
    """Values in millionths, as text, formed once a week and not once a window."""
    texts = of_weeks(weekly.weekly_arrays(weekly.store_weeks(r.sales)), lambda v: F.round(v * 1e6).cast("bigint").cast("string"))
    return windows.sliding_windows(texts).withColumns({m: F.array_join(m, ",") for m in WINDOWED})


@query("window_features", with_views("SELECT * FROM windows", FACTS, windowed(WINDOWED)))
def window_features(r: Retail):
    return windows.window_features(of_weeks(weekly.weekly_arrays(weekly.store_weeks(r.sales)), lambda v: F.round(v, 6)))


@query("window_features_compat", with_views(
    f"SELECT * FROM (SELECT internal_store_id, week, {lagged(WINDOWED)}, "
    "CASE WHEN LAG(sold, 12) OVER w AND premise = 'On Premise' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS premise "
    "FROM calendar JOIN active ON pdv = internal_store_id WINDOW w AS (PARTITION BY internal_store_id ORDER BY week)) "
    "WHERE week >= 13", FACTS,
))
def window_features_compat(r: Retail):
    return windows.window_features(of_weeks(weekly.weekly_arrays(r.facts), lambda v: F.round(v, 6)), attributes_at_start=True)


@query("window_slice_week", with_views(
    f"SELECT * FROM windows WHERE week = 47", FACTS, windowed(WINDOWED)
))
def window_slice_week(r: Retail):
    arrays = weekly.weekly_arrays(weekly.store_weeks(r.sales))
    frame = windows.window_features(arrays, last_weeks=[47])
    return rounded(frame, [c for c in frame.columns if c[-2:].isdigit()])


@query("train_targets", with_views(
    "SELECT internal_store_id, week, " + ", ".join(windows.target_columns()) + " FROM windows",
    FACTS, windowed(["quantity"]),
))
def train_targets(r: Retail):
    arrays = weekly.weekly_arrays(weekly.store_weeks(r.sales, ("quantity",), products=False), columns=("quantity",))
    return windows.train_targets(windows.window_features(arrays, measures=("quantity",)))


FEATURE_MEASURES = ("quantity", "net_value", "gross_profit")
# Groups of zip codes stand in for the density clusters, which SQL cannot number.
GROUP_SQL = "(zipcode - 8100) // 5"


def feature_sql(source: Callable[[int], int], week: int = 52) -> str:
    """Feature block with lag k read from window position source(k)."""
    picked = ", ".join(
        f"{m}{source(k):02d} AS {m}{k:02d}" for m in FEATURE_MEASURES for k in range(1, LAGS + 1)
    )
    return with_views(
        f"SELECT internal_store_id, {picked}, CAST({GROUP_SQL} AS INTEGER) AS cluster, CAST(premise = 'On Premise' AS INTEGER) AS premise "
        f"FROM windows JOIN active ON pdv = internal_store_id WHERE week = {week}",
        FACTS, windowed(FEATURE_MEASURES),
    )


def numbered_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c[-2:].isdigit()]


@query("select_feature_block", feature_sql(lambda k: k))
def select_feature_block(r: Retail):
    frame = r.grouped_windows([52])
    block = frame.select(STORE, *windows.feature_columns(frame))
    return rounded(block, numbered_columns(block))


@query("scoring_features", feature_sql(lambda k: k + 5))
def scoring_features(r: Retail):
    block = windows.scoring_frame(r.grouped_windows([52]))
    return rounded(block, numbered_columns(block))


@query("scoring_features_compat", feature_sql(lambda k: k + 5 if k <= 5 else k))
def scoring_features_compat(r: Retail):
    block = windows.scoring_frame(r.grouped_windows([52]), mode="compat")
    return rounded(block, numbered_columns(block))


@query("nonzero_forecast_rows", with_views(
    f"SELECT * FROM naive WHERE {' + '.join(f'column_{h}' for h in range(HORIZON))} > 0",
    FACTS, windowed(["quantity"]), NAIVE,
))
def nonzero_forecast_rows(r: Retail):
    return alloc.nonzero_forecasts(r.naive())


@query("unpivot_horizons", with_views(
    " UNION ALL ".join(
        f"SELECT internal_store_id, '{h + 1}' AS semana, column_{h} AS quantidade FROM naive" for h in range(HORIZON)
    ), FACTS, windowed(["quantity"]), NAIVE,
))
def unpivot_horizons(r: Retail):
    return alloc.unpivot_horizons(r.naive(), [STORE])


SCALED_SQL = with_views(
    "SELECT internal_store_id, internal_product_id AS produto, "
    + ", ".join(stable(f"share * column_{h}", f"column_{h}") for h in range(HORIZON))
    + " FROM naive JOIN stores ON pdv = internal_store_id JOIN shares USING (categoria_pdv)",
    FACTS, windowed(["quantity"]), NAIVE, BRAND_BANDIT,
)


def scaled_arrays(r: Retail) -> DataFrame:
    forecasts = r.naive().join(r.stores.select(F.col("pdv").alias(STORE), CATEGORY), STORE)
    return alloc.scale_share_arrays(forecasts, bandit.category_lists(r.brand_shares))


@query("explode_shares", SCALED_SQL)
def explode_shares(r: Retail):
    return steadied(alloc.explode_shares(scaled_arrays(r)), alloc.HORIZON_COLUMNS)


@query("scale_share_arrays", with_views(
    f"SELECT internal_store_id, COUNT(*) AS products, "
    + ", ".join(stable(f"SUM(share * column_{h})", f"column_{h}") for h in range(HORIZON))
    + " FROM naive JOIN stores ON pdv = internal_store_id JOIN shares USING (categoria_pdv) GROUP BY 1",
    FACTS, windowed(["quantity"]), NAIVE, BRAND_BANDIT,
))
def scale_share_arrays(r: Retail):
    return scaled_arrays(r).select(
        STORE, F.size("produto").cast("long").alias("products"),
        *[nearest(F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v)).alias(c) for c in alloc.HORIZON_COLUMNS],
    )


# ---------------------------------------------------------------- product propensity

@query("bandit_arms", with_views(
    "SELECT categoria_pdv, internal_product_id, 1 AS alpha, 1 AS beta, 0.0::DOUBLE AS probability FROM arm_weeks", PRODUCT_BANDIT
))
def bandit_arms(r: Retail):
    return bandit.arm_table(r.arms)


@query("bandit_posterior", with_views(
    "SELECT categoria_pdv, internal_product_id, CAST(1 + n AS INTEGER) AS alpha, CAST(53 - n AS INTEGER) AS beta FROM arm_weeks",
    PRODUCT_BANDIT,
))
def bandit_posterior(r: Retail):
    return bandit.posterior(r.arms)


@query("bandit_last_draw_params", with_views(
    "SELECT categoria_pdv, internal_product_id, CAST(a AS INTEGER) AS alpha, CAST(b AS INTEGER) AS beta FROM params",
    PRODUCT_BANDIT,
))
def bandit_last_draw_params(r: Retail):
    return bandit.last_draw_parameters(r.arms)


@query("bandit_draw", with_views(
    f"SELECT categoria_pdv, internal_product_id, {stable('probability', 'probability')} FROM drawn", PRODUCT_BANDIT
))
def bandit_draw(r: Retail):
    return steadied(bandit.draw(r.arms, SEED), ["probability"])


@query("bandit_trajectory", with_views(
    "SELECT categoria_pdv, internal_product_id, CAST(week AS INTEGER) AS week, "
    "CAST(1 + SUM(hit) OVER w AS INTEGER) AS alpha, CAST(1 + week - SUM(hit) OVER w AS INTEGER) AS beta FROM ("
    "SELECT a.categoria_pdv, a.internal_product_id, c.week, CASE WHEN s.wk IS NULL THEN 0 ELSE 1 END AS hit "
    "FROM arm_weeks a CROSS JOIN (SELECT UNNEST(range(1, 53)) AS week) c LEFT JOIN ("
    "SELECT DISTINCT categoria_pdv, internal_product_id, wk FROM positive JOIN stores ON pdv = internal_store_id) s "
    "ON s.categoria_pdv = a.categoria_pdv AND s.internal_product_id = a.internal_product_id AND s.wk = c.week) "
    "WINDOW w AS (PARTITION BY categoria_pdv, internal_product_id ORDER BY week)",
    PRODUCT_BANDIT,
))
def bandit_trajectory(r: Retail):
    return bandit.trajectory(r.arms)


@query("category_shares", with_views(
    f"SELECT categoria_pdv, internal_product_id, {stable('probability', 'probability')}, {stable('share', 'share')} FROM shares",
    PRODUCT_BANDIT,
))
def category_shares(r: Retail):
    return steadied(bandit.category_shares(bandit.draw(r.arms, SEED)), ["probability", "share"])


# ---------------------------------------------------------------- store features

@query("zip_ordinal", with_views(
    "SELECT pdv, zipcode, code AS zip_code FROM profile JOIN codes USING (zipcode)", PROFILE
))
def zip_ordinal(r: Retail):
    kept = r.profile.select("pdv", "zipcode")
    return kept.join(profile.ordinal_codes(kept, "zipcode").withColumnRenamed("code", "zip_code"), "zipcode")


@query("store_features_scaled", with_views(
    "SELECT pdv, " + ", ".join(grid(c) for c in profile.CLUSTER_FEATURES) + " FROM scaled", PROFILE
))
def store_features_scaled(r: Retail):
    return rounded(profile.scaled_store_features(r.profile), profile.CLUSTER_FEATURES)


# ---------------------------------------------------------------- density clustering

# Fixed parameters: with 1,500 stores no group reaches the production size of 100.
EPSILON, MIN_SIZE = 0.5, 10
PAIRS = f"pairs AS (SELECT a.pdv, b.pdv AS other, {DISTANCE} AS d FROM scaled a CROSS JOIN scaled b)"
CORES = (
    f"cores AS (SELECT pdv, d AS core FROM (SELECT pdv, d, row_number() OVER (PARTITION BY pdv ORDER BY d) AS rn FROM pairs) "
    f"WHERE rn = {MIN_SIZE})"
)


@query("eps_neighbours", with_views(
    f"SELECT pdv, COUNT(*) AS neighbours FROM pairs WHERE d <= {EPSILON} GROUP BY 1", PROFILE, PAIRS
))
def eps_neighbours(r: Retail):
    return radius.neighbour_counts(r.scaled, profile.CLUSTER_FEATURES, EPSILON)


@query("core_distances", with_views(f"SELECT pdv, {grid('core')} FROM cores", PROFILE, PAIRS, CORES))
def core_distances(r: Retail):
    return rounded(density.store_core_distances(r.space, MIN_SIZE), ["core"])


@query("reachability_mst")
def reachability_mst(r: Retail):
    return density.spanning_tree(r.hierarchy(MIN_SIZE))


# Grows the tree from the first key, one key a step: the nearest key outside, then the distances it shortens.
GROWN_TREE = (
    "reach AS MATERIALIZED (SELECT p.pdv, p.other, greatest(d, a.core, b.core) AS w FROM pairs p JOIN cores a ON a.pdv = p.pdv "
    "JOIN cores b ON b.pdv = p.other WHERE p.pdv <> p.other)",
    "grown(pdv, best, done) USING KEY (pdv) AS ("
    "SELECT pdv, CASE WHEN pdv = (SELECT MIN(pdv) FROM cores) THEN -1.0 ELSE 1e308 END, FALSE FROM cores UNION ("
    "WITH pick AS (SELECT pdv, best FROM recurring.grown WHERE NOT done ORDER BY best, pdv LIMIT 1) "
    "SELECT pdv, best, TRUE FROM pick UNION ALL "
    "SELECT n.pdv, r.w, FALSE FROM pick JOIN reach r ON r.pdv = pick.pdv JOIN recurring.grown n ON n.pdv = r.other WHERE NOT n.done AND r.w < n.best))",
)


@query("mst_weights", with_views(
    "SELECT round(best, 6) AS distance, COUNT(*) AS edges FROM grown WHERE best >= 0 GROUP BY 1", PROFILE, PAIRS, CORES, *GROWN_TREE))
def mst_weights(r: Retail):
    """The weights of the spanning tree, which are the same for all spanning trees of least weight."""
    tree = density.spanning_tree(r.hierarchy(MIN_SIZE))
    return tree.groupBy(F.round("distance", 6).alias("distance")).agg(F.count("*").alias("edges"))


@query("density_components", with_views(
    "SELECT c.pdv, COALESCE(m.component, c.pdv) AS component, c.core <= 0.5 AS is_core FROM cores c LEFT JOIN ("
    "SELECT pdv, MIN(other) AS component FROM reach GROUP BY 1) m ON m.pdv = c.pdv",
    PROFILE, PAIRS, CORES,
    f"near AS (SELECT p.pdv, p.other FROM pairs p JOIN cores a ON a.pdv = p.pdv JOIN cores b ON b.pdv = p.other "
    f"WHERE greatest(d, a.core, b.core) <= {EPSILON})",
    "reach AS (SELECT pdv, other FROM near UNION SELECT r.pdv, n.other FROM reach r JOIN near n ON n.pdv = r.other)",
))
def density_components(r: Retail):
    return radius.density_components(r.scaled, profile.CLUSTER_FEATURES, EPSILON, MIN_SIZE)


@query("store_clusters")
def store_clusters(r: Retail):
    return r.clustered(MIN_SIZE, EPSILON)


# ---------------------------------------------------------------- models and metrics

@query("train_features_scaled", with_views(
    "SELECT internal_store_id, " + ", ".join(
        f"round(({m}{k + 5:02d} - AVG({m}{k:02d}) OVER ()) / STDDEV_POP({m}{k:02d}) OVER (), 6) AS {m}{k:02d}"
        for m in FEATURE_MEASURES for k in range(1, LAGS + 1)
    ) + ", " + ", ".join(
        f"round(({e} - AVG({e}) OVER ()) / STDDEV_POP({e}) OVER (), 6) AS {n}"
        for n, e in (("cluster", GROUP_SQL), ("premise", "CAST(premise = 'On Premise' AS INTEGER)"))
    ) + " FROM windows JOIN active ON pdv = internal_store_id WHERE week = 52",
    FACTS, windowed(FEATURE_MEASURES),
))
def train_features_scaled(r: Retail):
    frame = r.grouped_windows([52])
    names = windows.feature_columns(frame)
    fitted = profile.scaler_statistics(windows.training_frame(frame, 52), names)
    scored = windows.scoring_frame(frame, 52)
    return rounded(profile.apply_scaler(scored, fitted, names), names)


TARGETS = windows.target_columns()


@query("binary_targets", with_views(
    "SELECT internal_store_id, " + ", ".join(f"CAST({t} > 0 AS DOUBLE) AS {t}" for t in TARGETS)
    + " FROM windows WHERE week = 52", FACTS, windowed(["quantity"]),
))
def binary_targets(r: Retail):
    return forecast.binary_targets(r.windows(("quantity",), last_weeks=[52]), TARGETS)


# Chances of a sale for gate tests: sold weeks among the last four lags before each horizon.
def _chance_sql(h: int) -> str:
    return "(" + " + ".join(f"CAST(quantity{LAGS + h - i:02d} > 0 AS DOUBLE)" for i in range(4)) + ") / 4"


@query("hurdle_gate", with_views(
    "SELECT internal_store_id, " + ", ".join(
        f"CASE WHEN {_chance_sql(h)} > {THRESHOLD} THEN quantity{LAGS + 1 + h:02d} ELSE 0 END AS column_{h}"
        for h in range(HORIZON)
    ) + ", " + ", ".join(
        f"CASE WHEN {_chance_sql(h)} = (SELECT MAX(greatest({', '.join(_chance_sql(i) for i in range(HORIZON))})) "
        f"FROM windows WHERE week = 52) THEN quantity{LAGS + 1 + h:02d} ELSE 0 END AS top_{h}"
        for h in range(HORIZON)
    ) + " FROM windows WHERE week = 52", FACTS, windowed(["quantity"]),
))
def hurdle_gate(r: Retail):
    def chance(h: int) -> Column:
        return sum((F.col(numbered("quantity", LAGS + h - i)) > 0).cast("double") for i in range(4)) / 4

    frame = r.windows(("quantity",), last_weeks=[52]).select(
        STORE, *[chance(h).alias(f"chance_{h}") for h in range(HORIZON)],
        *[F.col(t).alias(f"amount_{h}") for h, t in enumerate(TARGETS)],
    )
    chances, amounts = [f"chance_{h}" for h in range(HORIZON)], [f"amount_{h}" for h in range(HORIZON)]
    gated = forecast.gate(frame, chances, amounts, alloc.HORIZON_COLUMNS, THRESHOLD, (STORE, *chances, *amounts))
    return forecast.gate(
        gated, chances, amounts, [f"top_{h}" for h in range(HORIZON)], 1, (STORE, *alloc.HORIZON_COLUMNS)
    )


def naive_errors(r: Retail) -> DataFrame:
    """The five weeks before the targets, used as their forecast."""
    frame = r.windows(("quantity",), last_weeks=[52])
    guesses = [numbered("quantity", LAGS - HORIZON + 1 + h) for h in range(HORIZON)]
    return metrics.long_errors(frame, TARGETS, guesses)


def metric_sql(name: str, aggregate: str) -> str:
    errors = "errors AS (" + " UNION ALL ".join(
        f"SELECT {h + 1} AS horizon, quantity{LAGS + 1 + h:02d} AS y, quantity{LAGS - HORIZON + 1 + h:02d} AS p "
        "FROM windows WHERE week = 52" for h in range(HORIZON)
    ) + f"), per_horizon AS (SELECT CAST(horizon AS VARCHAR) AS horizon, {aggregate} AS v FROM errors GROUP BY 1)"
    return with_views(
        f"SELECT horizon, {stable('v', name)} FROM per_horizon UNION ALL SELECT 'mean', {stable('AVG(v)', name)} FROM per_horizon",
        FACTS, windowed(["quantity"]), errors,
    )


@query("metric_mae", metric_sql("mae", "AVG(abs(y - p))"))
def metric_mae(r: Retail):
    return steadied(metrics.mae(naive_errors(r)), ["mae"])


@query("metric_mape1", metric_sql("mape1", "AVG(abs(y - p) / greatest(y, 1.0))"))
def metric_mape1(r: Retail):
    return steadied(metrics.mape1(naive_errors(r)), ["mape1"])


@query("metric_medae", metric_sql("medae", "MEDIAN(abs(y - p))"))
def metric_medae(r: Retail):
    return steadied(metrics.median_absolute_error(naive_errors(r)), ["medae"])


@query("windows_all_years", with_views(
    "SELECT categoria_pdv, e.week, " + ", ".join(stable(f"SUM(CASE WHEN f.week = e.week - {13 - k} THEN quantity ELSE 0 END)", f"quantity{k:02d}") for k in range(1, 14))
    + " FROM ends e CROSS JOIN (SELECT DISTINCT categoria_pdv FROM active) c "
    "LEFT JOIN by_week f USING (categoria_pdv) GROUP BY categoria_pdv, e.week",
    "by_week AS (SELECT categoria_pdv, (date_diff('day', DATE '1970-01-01', transaction_date) + 3) // 7 AS week, SUM(quantity) AS quantity "
    "FROM sales JOIN active ON pdv = internal_store_id GROUP BY 1, 2), "
    "ends AS (SELECT UNNEST(range((SELECT MIN(week) + 12 FROM by_week), (SELECT MAX(week) + 1 FROM by_week))) AS week)",
))
def windows_all_years(r: Retail):
    """Every window of every store over the whole history, summed by category."""
    found = timeline.long_windows(timeline.ordinal_facts(r.positive, ["quantity"]), ["quantity"])
    columns = [numbered("quantity", k) for k in range(1, LAGS + HORIZON + 1)]
    categories = r.stores.select(F.col("pdv").alias(STORE), CATEGORY)
    return steadied(found.join(categories, STORE).groupBy(CATEGORY, "week").agg(*[F.sum(c).alias(c) for c in columns]), columns)


# ---------------------------------------------------------------- fitted models

HURDLE = forecast.HurdleSettings(threshold=THRESHOLD)
LAST = 52


def clustered_windows(r: Retail, last_weeks: Sequence[int]) -> DataFrame:
    """Windows of all stores with their clusters, once per session."""
    def build():
        attributes = weekly.store_attributes(r.clustered(MIN_SIZE, EPSILON))
        return cut(windows.store_windows(r.positive, attributes, windows.windowed_measures(), last_weeks=last_weeks))
    return r.once(f"windows{list(last_weeks)}", build)


def fitted(r: Retail) -> tuple[forecast.HurdleModel, DataFrame]:
    """The hurdle model of the last week and its training frame, once per session."""
    def build():
        frame = clustered_windows(r, [LAST])
        train = cut(windows.training_frame(frame, LAST))
        return forecast.fit_hurdle(train, windows.feature_columns(frame), TARGETS, HURDLE), train
    return r.once("fitted", build)


@query("forecast_regressor")
def forecast_regressor(r: Retail):
    model, train = fitted(r)
    return model.components(train, (STORE,)).select(STORE, *[f"amount_{h}" for h in range(HORIZON)])


@query("sale_probability")
def sale_probability(r: Retail):
    model, train = fitted(r)
    return model.components(train, (STORE,)).select(STORE, *[f"chance_{h}" for h in range(HORIZON)])


@query("hurdle_forecast")
def hurdle_forecast(r: Retail):
    model, train = fitted(r)
    return model.predict(train)


@query("forecast_next_weeks")
def forecast_next_weeks(r: Retail):
    return forecast.forecast_next_weeks(clustered_windows(r, [LAST]), [LAST], settings=HURDLE)


# Origins of the rolling backtest.
ORIGINS = (42, 47, 52)


@query("backtest")
def backtest(r: Retail):
    weeks = sorted({w - d for w in ORIGINS for d in (0, HORIZON)})
    return forecast.backtest(clustered_windows(r, weeks), ORIGINS, settings=HURDLE)


@query("backtest_naive", with_views(
    "SELECT week, model, horizon, " + stable("mae", "mae") + ", " + stable("mape1", "mape1") + ", all_zero FROM ("
    "SELECT week, model, CAST(horizon AS VARCHAR) AS horizon, mae, mape1, p = 0 AS all_zero FROM per_horizon UNION ALL "
    "SELECT week, model, 'mean', AVG(mae), AVG(mape1), SUM(p) = 0 FROM per_horizon GROUP BY 1, 2)",
    FACTS, windowed(["quantity"]),
    "errors AS (" + " UNION ALL ".join(
        f"SELECT week, '{model}' AS model, {h + 1} AS horizon, quantity{LAGS + 1 + h:02d} AS y, {p} AS p FROM windows WHERE week IN {ORIGINS}"
        for h in range(HORIZON) for model, p in (("naive", f"quantity{LAGS - HORIZON + 1 + h:02d}"), ("zero", "0.0::DOUBLE"))
    ) + "), per_horizon AS (SELECT week, model, horizon, AVG(abs(y - p)) AS mae, AVG(abs(y - p) / greatest(y, 1.0)) AS mape1, "
    "SUM(p) AS p FROM errors GROUP BY 1, 2, 3)",
))
def backtest_naive(r: Retail):
    """The yardsticks of the backtest at every origin: the weeks before, and nothing."""
    frame = r.windows(("quantity",), last_weeks=list(ORIGINS))
    return steadied(forecast.yardsticks(frame, TARGETS, ("week",)), ["mae", "mape1"])


@query("plan_stores", with_views("SELECT pdv AS internal_store_id FROM active"))
def plan_stores(r: Retail):
    """Stores with a forecast: all that ever sold."""
    model, _ = fitted(r)
    return model.predict(windows.scoring_frame(clustered_windows(r, [LAST]), LAST)).select(STORE)


@query("calendar_null_fill", with_views(
    "SELECT c.categoria_pdv, CAST(w.week AS INTEGER) AS week, " + stable("COALESCE(quantity, 0)", "quantity") + ", "
    + stable("COALESCE(net_value, 0)", "net_value") + " FROM (SELECT DISTINCT categoria_pdv FROM nulled) c "
    "CROSS JOIN (SELECT UNNEST(range(1, 53)) AS week) w LEFT JOIN nulled n ON n.categoria_pdv = c.categoria_pdv AND n.week = w.week",
    "nulled AS (SELECT categoria_pdv, wk AS week, AVG(quantity) AS quantity, AVG(CASE WHEN wk % 2 = 1 THEN net_value END) AS net_value "
    "FROM sales JOIN active ON pdv = internal_store_id GROUP BY 1, 2)",
))
def calendar_null_fill(r: Retail):
    """A calendar in which one measure is null in all sales of every second week."""
    even = cols.week_of(F.col("transaction_date")) % 2 == 0
    sales = r.positive.withColumn("net_value", F.when(~even, F.col("net_value")))
    facts = weekly.weekly_facts(sales, r.stores, CATEGORY)
    return steadied(weekly.dense_calendar(facts, CATEGORY, ("quantity", "net_value")), ["quantity", "net_value"])


def tuning_frame(r: Retail) -> tuple[DataFrame, list[str]]:
    frame = clustered_windows(r, [LAST])
    return cut(windows.training_frame(frame, LAST)), windows.feature_columns(frame)


@query("tune_regressor")
def tune_regressor(r: Retail):
    frame, names = tuning_frame(r)
    return tuning.tune_regressor(frame, names, TARGETS)


@query("tune_classifier")
def tune_classifier(r: Retail):
    frame, names = tuning_frame(r)
    return tuning.tune_classifier(frame, names, TARGETS)


# ---------------------------------------------------------------- allocation

ALLOCATE_SQL = with_views(
    "SELECT semana, pdv, produto, CAST(floor(quantidade) AS INTEGER) AS quantidade FROM (" + " UNION ALL ".join(
        f"SELECT '{h + 1}' AS semana, pdv, internal_product_id AS produto, share * column_{h} AS quantidade "
        "FROM naive JOIN active ON pdv = internal_store_id JOIN shares USING (categoria_pdv)" for h in range(HORIZON)
    ) + ") WHERE floor(quantidade) > 0",
    FACTS, windowed(["quantity"]), NAIVE, BRAND_BANDIT,
)


@query("allocate", ALLOCATE_SQL)
def allocate(r: Retail):
    return alloc.allocate(r.naive(), r.brand_shares, r.stores)


@query("csv_roundtrip", ALLOCATE_SQL)
def csv_roundtrip(r: Retail):
    path = scratch_path(r.spark, "plan")
    tables.write_plan(allocate(r), path)
    return tables.read_plan_csv(r.spark, path)


@query("forecast_plan")
def forecast_plan(r: Retail):
    """Complete run with fitted models; brands as products."""
    settings = weekly_plan.PlanSettings(MIN_SIZE, EPSILON, seed=SEED, hurdle=HURDLE)
    brands = r.sku.select(F.col("produto").alias(PRODUCT), F.col("subcategoria").alias("brand"))
    transactions = r.transactions.join(brands, PRODUCT).withColumn(PRODUCT, F.col("brand")).drop("brand")
    return weekly_plan.plan(transactions, r.stores, settings)
