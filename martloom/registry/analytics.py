"""Customer scoring, actions, revenue drivers, forecasts, question intents."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions.intent import intent_pattern_sql, question_intent
from martloom.operators.checks import missing_values
from martloom.plans import backtest, changepoints, forecast, growth, rfm
from martloom.registry.core import Context, query

PERIOD = 199806
TOP_SEGMENT = "Loyal Customers"
RFM_SQL = (
    "SELECT customer_key, CAST(last_purchase AS VARCHAR) AS last_purchase, recency_days, sales_orders_12m,"
    " CAST(gross_sales_12m AS DOUBLE) AS gross_sales_12m, r, f, m, fm, segment FROM rfm"
)


def _scores(c: Context):
    return rfm.customer_rfm(c.gold("fct_sales_details"))


@query("rfm", RFM_SQL, ("rfm",))
def rfm_table(c: Context):
    return _scores(c)


@query("rfm_score", "SELECT customer_key, r, f, m FROM rfm", ("rfm",))
def rfm_score(c: Context):
    return rfm.rfm_score(c.gold("fct_sales_details")).select("customer_key", "score.r", "score.f", "score.m")


@query(
    "rfm_segments",
    "SELECT r, fm, segment, count(*) AS qtd_clientes FROM rfm GROUP BY ALL",
    ("rfm",),
)
def rfm_segments(c: Context):
    return _scores(c).groupBy("r", "fm", "segment").agg(F.count(F.lit(1)).alias("qtd_clientes"))


@query(
    "udf_customer_segment",
    "SELECT c_custkey AS customer_key, segment FROM customer LEFT JOIN rfm ON customer_key = c_custkey",
    ("rfm",),
)
def udf_customer_segment(c: Context):
    rfm.register_customer_segment(c.spark, _scores(c))
    c.gold("dim_customer").createOrReplaceTempView("customers_to_segment")
    return c.spark.sql(
        "SELECT customer_key, customer_segment(customer_key) AS segment FROM customers_to_segment"
    )


def _actions(c: Context):
    return rfm.customer_actions(_scores(c))


@query(
    "reco_actions",
    "SELECT customer_key, segment, intent, suggested_lever, rationale, priority, recency_days, sales_orders_12m,"
    " CAST(gross_sales_12m AS DOUBLE) AS gross_sales_12m FROM action",
    ("action",),
)
def reco_actions(c: Context):
    return _actions(c)


@query(
    "reco_coverage",
    "SELECT count(*) AS total_rows, count(*) - count(intent) AS missing_rows FROM action",
    ("action",),
)
def reco_coverage(c: Context):
    return missing_values(_actions(c), "intent")


URGENCY_SQL = "CASE priority WHEN 'Alta' THEN 1 WHEN 'Média' THEN 2 ELSE 3 END"


@query(
    "serve_recommend",
    f"SELECT customer_key, segment, intent, suggested_lever, priority, CAST(gross_sales_12m AS DOUBLE) AS gross_sales_12m FROM action"
    f" ORDER BY {URGENCY_SQL}, action.gross_sales_12m DESC, customer_key LIMIT 100",
    ("action",),
)
def serve_recommend(c: Context):
    return rfm.served_actions(_actions(c))


@query(
    "serve_recommend_segment",
    f"SELECT customer_key, segment, intent, suggested_lever, priority, CAST(gross_sales_12m AS DOUBLE) AS gross_sales_12m FROM action"
    f" WHERE segment = '{TOP_SEGMENT}' ORDER BY {URGENCY_SQL}, action.gross_sales_12m DESC, customer_key LIMIT 100",
    ("action",),
)
def serve_recommend_segment(c: Context):
    return rfm.served_actions(_actions(c), TOP_SEGMENT)


def _drivers(c: Context):
    return growth.price_volume_mix(c.gold("fct_sales_details"), c.gold("dim_product"))


EFFECTS_SQL = "delta_revenue, effect_volume, effect_price, effect_mix"


@query(
    "pvm_drivers",
    f"SELECT comparison_type, year_month, CAST(month_start AS VARCHAR) AS month_start, subcategory, {EFFECTS_SQL} FROM pvm",
    ("pvm",),
)
def pvm_drivers(c: Context):
    return _drivers(c)


@query(
    "pvm_keys",
    "SELECT comparison_type, CAST(month_start AS VARCHAR) AS month_start, subcategory FROM pvm",
    ("pvm",),
)
def pvm_keys(c: Context):
    months = growth.subcategory_months(c.gold("fct_sales_details"), c.gold("dim_product"))
    return growth.pvm_pairs(months).select("comparison_type", "month_start", "subcategory")


@query(
    "pvm_closure",
    """SELECT comparison_type, year_month, round(sum(effect_volume + effect_price + effect_mix), 2) AS soma_efeitos,
         round(sum(delta_revenue), 2) AS delta_real
       FROM pvm GROUP BY 1, 2
       HAVING abs(round(sum(effect_volume + effect_price + effect_mix), 2) - round(sum(delta_revenue), 2)) > 0.01""",
    ("pvm",),
)
def pvm_closure(c: Context):
    return growth.pvm_closure(_drivers(c))


@query(
    "pvm_month_totals",
    """SELECT comparison_type, year_month, round(sum(effect_volume), 2) AS vol, round(sum(effect_price), 2) AS preco,
         round(sum(effect_mix), 2) AS mix, round(sum(delta_revenue), 2) AS delta
       FROM pvm GROUP BY 1, 2""",
    ("pvm",),
)
def pvm_month_totals(c: Context):
    return _drivers(c).groupBy("comparison_type", "year_month").agg(
        F.round(F.sum("effect_volume"), 2).alias("vol"),
        F.round(F.sum("effect_price"), 2).alias("preco"),
        F.round(F.sum("effect_mix"), 2).alias("mix"),
        F.round(F.sum("delta_revenue"), 2).alias("delta"),
    )


@query(
    "serve_pvm",
    f"SELECT year_month, subcategory, {EFFECTS_SQL} FROM pvm WHERE comparison_type = 'YoY'",
    ("pvm",),
)
def serve_pvm(c: Context):
    return growth.served_pvm(_drivers(c))


@query(
    "pvm_reading",
    f"""SELECT subcategory, round(delta_revenue, 0) AS delta, round(effect_volume, 0) AS vol,
          round(effect_price, 0) AS preco, round(effect_mix, 0) AS mix
        FROM pvm WHERE comparison_type = 'YoY' AND year_month = {PERIOD}""",
    ("pvm",),
)
def pvm_reading(c: Context):
    return growth.pvm_reading(_drivers(c), PERIOD)


def _history(c: Context, *series: str):
    sales = c.gold("fct_sales_details")
    if series:
        return forecast.product_history(sales, c.gold("dim_product"), *series)
    return forecast.monthly_history(sales)


@query(
    "forecast_history",
    "SELECT CAST(CAST(date_trunc('month', order_date) AS DATE) AS VARCHAR) AS ds, CAST(sum(gross_sales) AS DOUBLE) AS y FROM fct GROUP BY 1",
    ("fct",),
)
def forecast_history(c: Context):
    return _history(c)


def _forecast_sql(series: str, joined: str, history: str = "") -> tuple[str, str]:
    """The model restated: ordinary least squares in closed form, ratios to trend, residual spread."""
    key = f"{series}, " if series else ""
    part = f"PARTITION BY {series}" if series else ""
    on = "USING (" + series + ")" if series else "ON true"
    group = f"GROUP BY {series}" if series else ""
    monthly = f"""SELECT {key}CAST(date_trunc('month', order_date) AS DATE) AS ds, CAST(sum(gross_sales) AS DOUBLE) AS y
          FROM {joined} GROUP BY ALL"""
    model = f"""h AS ({history or monthly}),
        p AS (SELECT *, month(ds) AS moy, CAST(year(ds) * 12 + month(ds) - min(year(ds) * 12 + month(ds)) OVER ({part}) AS DOUBLE) AS t FROM h),
        q AS (SELECT {key}count(*) AS n, avg(t) AS mt, avg(y) AS my, sum(t * t) - count(*) * avg(t) * avg(t) AS sxx,
                sum(t * y) - count(*) * avg(t) * avg(y) AS sxy, max(ds) AS last_ds, max(t) AS last_t FROM p {group}),
        b AS (SELECT *, coalesce(sxy / nullif(sxx, 0), 0) AS slope, my - coalesce(sxy / nullif(sxx, 0), 0) * mt AS icept FROM q),
        s AS (SELECT {key}moy, avg(y / nullif(icept + slope * t, 0)) AS raw FROM p JOIN b {on} GROUP BY ALL),
        z AS (SELECT {key}moy, coalesce(raw / nullif(avg(raw) OVER ({part}), 0), 1) AS season FROM s),
        f AS (SELECT {key}p.ds, p.y, (icept + slope * t) * season AS yhat
              FROM p JOIN b {on} JOIN z {'USING (' + series + ', moy)' if series else 'USING (moy)'}),
        e AS (SELECT {key}sqrt(sum((y - yhat) * (y - yhat)) / greatest(count(*) - 2, 1)) AS spread FROM f {group}),
        u AS (SELECT {key}CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE) AS ds, CAST(NULL AS DOUBLE) AS y,
                icept + slope * (last_t + k) AS trend, month(CAST(last_ds + to_months(CAST(k AS INTEGER)) AS DATE)) AS moy
              FROM b CROSS JOIN range(1, 15) g(k)),
        a AS (SELECT {key}ds, y, yhat FROM f UNION ALL
              SELECT {key}ds, y, trend * coalesce(season, 1) FROM u LEFT JOIN z {'USING (' + series + ', moy)' if series else 'USING (moy)'})"""
    body = f"""SELECT {key}CAST(ds AS VARCHAR) AS ds, round(y, 2) AS y, round(yhat, 2) AS forecast,
          round(yhat - 1.2816 * spread, 2) AS forecast_lower, round(yhat + 1.2816 * spread, 2) AS forecast_upper
        FROM a JOIN e {on}"""
    return model, body


BY_CATEGORY, BY_CATEGORY_ROWS = _forecast_sql("category_name", "fct JOIN item USING (product_key)")
TOTAL, TOTAL_ROWS = _forecast_sql("", "fct")


def _rounded_forecast(df):
    return df.withColumns(
        {c: F.round(c, 2) for c in ("y", "forecast", "forecast_lower", "forecast_upper") if c in df.columns}
    ).drop("model_version")


@query("forecast_by_series", f", {BY_CATEGORY} {BY_CATEGORY_ROWS}", ("fct", "item"))
def forecast_by_series(c: Context):
    return _rounded_forecast(forecast.forecast(_history(c, "category_name"), "category_name"))


@query(
    "forecast_mae",
    f", {BY_CATEGORY} SELECT category_name, round(avg(abs(yhat - y)), 2) AS mae FROM f GROUP BY 1",
    ("fct", "item"),
)
def forecast_mae(c: Context):
    predicted = forecast.forecast(_history(c, "category_name"), "category_name")
    return forecast.in_sample_mae(predicted, "category_name").withColumn("mae", F.round("mae", 2))


# Held-out months of the plain model: the history up to each of four cut-offs is one more series.
CUT, _ = _forecast_sql("category_name, cutoff", "", "SELECT category_name, cutoff, ds, y FROM laid WHERE ds <= cutoff")
CUTOFFS = f"""mh AS (SELECT category_name, CAST(date_trunc('month', order_date) AS DATE) AS ds, CAST(sum(gross_sales) AS DOUBLE) AS y
      FROM fct JOIN item USING (product_key) GROUP BY ALL),
    cuts AS (SELECT category_name, CAST(max(ds) - to_months(CAST(6 + 3 * o AS INTEGER)) AS DATE) AS cutoff
      FROM mh CROSS JOIN range(0, 4) t(o) GROUP BY category_name, o),
    laid AS (SELECT mh.*, cutoff FROM mh JOIN cuts USING (category_name)
      QUALIFY count(*) FILTER (ds <= cutoff) OVER (PARTITION BY category_name, cutoff) >= 24), {CUT},
    met AS (SELECT category_name, cutoff, a.yhat - mh.y AS err, mh.y, abs(a.yhat - mh.y) <= 1.2816 * spread AS inside
      FROM a JOIN e USING (category_name, cutoff) JOIN mh USING (category_name, ds)
      WHERE a.y IS NULL AND ds <= cutoff + to_months(6))"""


def _rounded_errors(df):
    return df.withColumns(
        {"mae": F.round("mae", 2), "bias": F.round("bias", 2), "weighted_error": F.round("weighted_error", 6), "covered": F.round("covered", 6)}
    )


@query(
    "forecast_held_out",
    f""", {CUTOFFS} SELECT category_name, CAST(cutoff AS VARCHAR) AS cutoff, count(*) AS months, round(avg(abs(err)), 2) AS mae,
      round(avg(err), 2) AS bias, round(sum(abs(err)) / nullif(sum(abs(y)), 0), 6) AS weighted_error,
      round(avg(CAST(inside AS INTEGER)), 6) AS covered FROM met GROUP BY ALL""",
    ("fct", "item"),
)
def forecast_held_out(c: Context):
    return _rounded_errors(backtest.rolling_origin(_history(c, "category_name"), "category_name", model=forecast.forecast))


@query("forecast_models_compared")
def forecast_models_compared(c: Context):
    return _rounded_errors(backtest.compared(_history(c, "category_name"), "category_name"))


@query("forecast_bends")
def forecast_bends(c: Context):
    return _rounded_forecast(changepoints.forecast(_history(c, "category_name"), "category_name"))


@query("forecast_best_model")
def forecast_best_model(c: Context):
    best = backtest.best_forecast(_history(c, "category_name"), "category_name")
    version = F.col("model_version").alias("served_by")
    return _rounded_forecast(best.select("*", version)).withColumn("held_out_mae", F.round("held_out_mae", 2))


@query(
    "serve_forecast",
    f", {TOTAL} SELECT ds, forecast, forecast_lower, forecast_upper FROM ({TOTAL_ROWS})",
    ("fct",),
)
def serve_forecast(c: Context):
    return _rounded_forecast(forecast.served_forecast(forecast.forecast(_history(c))))


@query(
    "intent_tagging",
    f"SELECT conv_id, turn, {intent_pattern_sql('text')} AS intent FROM conversations WHERE role = 'user'",
)
def intent_tagging(c: Context):
    asked = c.sample.read("conversations").filter("role = 'user'")
    return asked.select("conv_id", "turn", question_intent(F.col("text")).alias("intent"))


@query(
    "intent_counts",
    f"SELECT role, {intent_pattern_sql('text', chr(39) + 'none' + chr(39))} AS intent, count(*) AS n FROM conversations GROUP BY ALL",
)
def intent_counts(c: Context):
    log = c.sample.read("conversations")
    return log.groupBy(
        "role", F.coalesce(question_intent(F.col("text")), F.lit("none")).alias("intent")
    ).agg(F.count(F.lit(1)).alias("n"))
