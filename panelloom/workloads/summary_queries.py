"""Summaries of the panel and the steps around the purchase model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators import model as J
from panelloom.operators import summary as I
from panelloom.operators.ranking import roc_auc
from panelloom.workloads.fixtures import Tables
from panelloom.workloads.panel_queries import features
from panelloom.workloads.registry import cte, query

METRICS = ("to_sum_val_opps_won", "to_number_of_opps", "customer_tenure", "sales_act_synchronous", "ts_sales_total_sw")


@query(
    "group_summary",
    "treatment:long n_observations:long n_customers:long "
    + " ".join(f"{m}_{f}:money" for m in METRICS for f in ("mean", "median", "sd", "min", "max")),
    "SELECT treatment, count(*) AS n_observations, count(DISTINCT customer_id) AS n_customers, "
    + ", ".join(
        f"avg({m}) AS {m}_mean, quantile_cont({m}, 0.5) AS {m}_median, stddev_samp({m}) AS {m}_sd, min({m}) AS {m}_min, max({m}) AS {m}_max"
        for m in METRICS
    )
    + " FROM featured GROUP BY 1",
)
def group_summary(t):
    panel = t.stored("panel", features(t).select("customer_id", "treatment", *METRICS))
    return I.group_summary(panel, ["treatment"], METRICS)


@query(
    "event_study_means",
    "time_to_treat:long treatment:long outcome_mean:money outcome_se:money n:long ci_low:money ci_high:money",
    """SELECT *, outcome_mean - 1.96 * outcome_se AS ci_low, outcome_mean + 1.96 * outcome_se AS ci_high
       FROM (SELECT time_to_treat, treatment, avg(to_sum_val_opps_won) AS outcome_mean,
                    stddev_samp(to_sum_val_opps_won) / sqrt(count(*)) AS outcome_se, count(*) AS n FROM featured GROUP BY 1, 2)""",
)
def event_study_means(t):
    return I.event_study(features(t), "to_sum_val_opps_won")


@query(
    "key_variable_summary",
    "column:text mean:money median:money min:money max:money n_missing:long missing_percent:ratio",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", avg({c}) AS mean, quantile_cont({c}, 0.5) AS median, min({c}) AS min, max({c}) AS max,
                   count(*) - count({c}) AS n_missing, round(100.0 * (count(*) - count({c})) / count(*), 1) AS missing_percent FROM featured"""
        for c in I.KEY_VARIABLES
    ),
)
def key_variable_summary(t):
    return I.key_variable_summary(t.stored("panel", features(t).select(*I.KEY_VARIABLES)))


@query(
    "panel_metadata",
    "n_rows:long n_customers:long n_treated:long first_year:long last_year:long n_countries:long",
    """SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, count(DISTINCT customer_id) FILTER (ever_treated = 1) AS n_treated,
              min(year) AS first_year, max(year) AS last_year, count(DISTINCT country) AS n_countries FROM featured""",
)
def panel_metadata(t):
    return I.panel_metadata(features(t))


@query(
    "value_counts",
    "priority:text n:long percent:ratio",
    """SELECT priority, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM v_activities), 1) AS percent
       FROM v_activities GROUP BY 1""",
)
def value_counts(t):
    return I.value_counts(t.view("v_activities"), "priority")


# --------------------------------------------------------------------------
# Model steps. The label is "the customer has a balance above 5000".
# --------------------------------------------------------------------------

_BUCKET = """CAST(concat('0x', substr(md5(concat(CAST(label AS VARCHAR), '|', CAST(customer_id AS VARCHAR))), 1, 8)) AS BIGINT) % 10000"""
cte(
    "labelled",
    """SELECT o_custkey AS customer_id, CASE WHEN max(o_totalprice) > 450000 THEN 1 ELSE 0 END AS label,
              CASE WHEN count(*) % 4 = 0 THEN NULL ELSE avg(o_totalprice) END AS mean_price,
              CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE max(o_orderpriority) END AS priority, count(*) AS n_orders
       FROM orders GROUP BY o_custkey""",
)
cte("split", f"SELECT *, {_BUCKET} < 8000 AS is_train, {_BUCKET} % 5 AS fold FROM labelled")


def labelled(t: Tables) -> DataFrame:
    return t.table("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.when(F.max("o_totalprice") > 450000, 1).otherwise(0).alias("label"),
        F.when(F.count("*") % 4 != 0, F.avg("o_totalprice")).alias("mean_price"),
        F.when(F.col("o_custkey") % 6 != 0, F.max("o_orderpriority")).alias("priority"),
        F.count("*").alias("n_orders"),
    )


def split(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = J.stratified_split(labelled(t), "customer_id", "label")
    return rows, rows.filter("is_train")


@query("stratified_split", "customer_id:long label:long is_train:bool", "SELECT * FROM split")
def stratified_split(t):
    return split(t)[0]


@query("stratified_folds", "customer_id:long label:long fold:long", "SELECT * FROM split")
def stratified_folds(t):
    return J.stratified_folds(labelled(t), "customer_id", "label")


@query(
    "impute_median",
    "customer_id:long mean_price:money n_orders:long",
    """SELECT customer_id, coalesce(mean_price, (SELECT quantile_cont(mean_price, 0.5) FROM split WHERE is_train)) AS mean_price, n_orders FROM split""",
)
def impute_median(t):
    rows, train = split(t)
    return J.impute(rows, J.fit_imputation(train, numeric=["mean_price"]))


@query(
    "impute_mode",
    "customer_id:long priority:text",
    """SELECT customer_id, coalesce(priority, (SELECT priority FROM split WHERE is_train AND priority IS NOT NULL
              GROUP BY 1 ORDER BY count(*) DESC, priority LIMIT 1)) AS priority FROM split""",
)
def impute_mode(t):
    rows, train = split(t)
    return J.impute(rows, J.fit_imputation(train, nominal=["priority"]))


@query(
    "standardise",
    "customer_id:long mean_price:ratio n_orders:ratio",
    """SELECT customer_id, (mean_price - (SELECT avg(mean_price) FROM split WHERE is_train)) / (SELECT stddev_samp(mean_price) FROM split WHERE is_train) AS mean_price,
              (n_orders - (SELECT avg(n_orders) FROM split WHERE is_train)) / (SELECT stddev_samp(n_orders) FROM split WHERE is_train) AS n_orders
       FROM split""",
)
def standardise(t):
    rows, train = split(t)
    return J.standardise(rows, J.fit_scaling(train, ["mean_price", "n_orders"]))


@query(
    "roc_auc_from_scores",
    "n_pos:long n_neg:long auc:ratio",
    """WITH s AS (SELECT l_quantity + l_tax AS score, CASE WHEN l_returnflag = 'R' OR l_extendedprice > 60000 THEN 1 ELSE 0 END AS label FROM lineitem),
            g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY 1),
            c AS (SELECT p, n, sum(n) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS below FROM g)
       SELECT sum(p) AS n_pos, sum(n) AS n_neg, sum(p * (below - n / 2.0)) / (sum(p) * sum(n)) AS auc FROM c""",
)
def roc_auc_from_scores(t):
    event = (F.col("l_returnflag") == "R") | (F.col("l_extendedprice") > 60000)
    scored = t.table("lineitem").select(
        (F.col("l_quantity") + F.col("l_tax")).alias("score"), F.when(event, 1).otherwise(0).alias("label")
    )
    return roc_auc(scored, "score", "label")


@query("purchase_classifier", "customer_id:long label:long pred_1:ratio")
def purchase_classifier(t):
    """Trained on the training rows, scored on the test rows (no SQL equivalent)."""
    rows, train = split(t)
    values = J.fit_imputation(train, numeric=["mean_price"], nominal=["priority"])
    filled = J.impute(rows, values)
    model = J.purchase_classifier(["mean_price", "n_orders"], ["priority"], "label").fit(filled.filter("is_train"))
    return J.score(model, filled.filter("NOT is_train"))


_NEWTON_STEPS = 12


def _newton_sql() -> str:
    """Ridge-weighted Newton steps for an intercept and a slope, each model without one fold."""
    parts = [
        "folded AS (SELECT fold, label, n_orders / 10.0 AS x FROM split)",
        "models AS (SELECT DISTINCT fold AS m FROM folded)",
        "b0 AS (SELECT m, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM models)",
    ]
    for k in range(_NEWTON_STEPS):
        parts.append(
            f"""s{k} AS (SELECT m, any_value(a) AS a, any_value(b) AS b, 1 + sum(p * (1 - p)) AS haa, sum(p * (1 - p) * x) AS hab,
                      1 + sum(p * (1 - p) * x * x) AS hbb, sum(label - p) - any_value(a) AS ga, sum((label - p) * x) - any_value(b) AS gb
                 FROM (SELECT m, a, b, label, x, 1 / (1 + exp(-(a + b * x))) AS p FROM folded JOIN b{k} ON fold <> m) GROUP BY m)"""
        )
        parts.append(
            f"""b{k + 1} AS (SELECT m, a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
                      b + (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM s{k})"""
        )
    parts.append(f"scored AS (SELECT fold, a, b, label, a + b * x AS z FROM folded JOIN b{_NEWTON_STEPS} ON fold = m)")
    parts.append("g AS (SELECT fold, any_value(a) AS a, any_value(b) AS b, z, sum(label) AS p, sum(1 - label) AS n FROM scored GROUP BY fold, z)")
    parts.append("c AS (SELECT *, sum(n) OVER (PARTITION BY fold ORDER BY z ROWS UNBOUNDED PRECEDING) AS below FROM g)")
    return "WITH " + ", ".join(parts) + """
       SELECT fold, any_value(a) AS intercept, any_value(b) AS slope, sum(p) AS n_pos, sum(n) AS n_neg,
              sum(p * (below - n / 2.0)) / nullif(sum(p) * sum(n), 0) AS auc FROM c GROUP BY fold"""


@query("purchase_cross_validation", "fold:long intercept:ratio slope:ratio n_pos:long n_neg:long auc:ratio", _newton_sql())
def purchase_cross_validation(t):
    """Each fold under the model fitted to the other folds: its coefficients and its AUC."""
    rows = J.stratified_folds(labelled(t), "customer_id", "label").withColumn("tens_of_orders", F.col("n_orders") / 10)
    by_fold, fit = J.cross_validate(rows, ["tens_of_orders"], "label", ridge=1.0)
    beta = J._beta(fit.coefficients, F.col("fold").cast("int"))
    return by_fold.select("fold", beta[0].alias("intercept"), beta[1].alias("slope"), "n_pos", "n_neg", "auc")
