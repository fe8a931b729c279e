"""Relationship, purchase and treatment (event-study) features, and the final filter."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from panelloom import config as C
from panelloom.config import PanelKeys
from panelloom.functions.logic import flag, matches, yes
from panelloom.operators.windows import fill, first_period_columns, periods_since

YEARLY = PanelKeys()

DEFAULT_PURCHASE_SERIES = ("to_cum_opps_won", "erp_registered_product_cum", "Manual_Registered_Product_cum")

# Columns that hold a point in time: a missing one stays missing in the final panel.
EVENT_TIME_COLUMNS = (
    "first_interaction",
    "first_purchase_year",
    "first_opp_year",
    "years_since_first_opp",
    "to_first_purchase_year",
    "to_hw_purchase_year",
    "to_sw_purchase_year",
    "ts_first_any_sw_year",
    "ts_first_explore_year",
    "ts_first_exploit_year",
    "ts_years_since_any_sw",
    "ts_years_since_explore",
    "ts_years_since_exploit",
    "ft_purchase_at_t_date",
    "lt_purchase_at_T_date",
    "duration_since_last_purchase",
    "time_to_treat",
    "customer_relationship_length_at_treatment",
)


def first_active_column(keys: PanelKeys = YEARLY) -> dict[str, Column]:
    return first_period_columns({"first_purchase_year": F.col("relationship_status") == C.ACTIVE}, keys)


def tenure_columns(keys: PanelKeys = YEARLY) -> dict[str, Column]:
    """Needs ``first_purchase_year``."""
    status, first = F.col("relationship_status"), F.col("first_purchase_year")
    since = keys.distance(first)
    return {
        "customer_tenure": F.when(yes(status == C.ACTIVE) & first.isNotNull(), since + 1).otherwise(0),
        "prospect_tenure": F.when(yes(status == C.PRE) & first.isNotNull(), -since).otherwise(0),
        "years_since_first_purchase": since,
    }


def tenure_features(panel: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """First active period, tenure (first active period counts as 1) and time as a prospect."""
    return panel.withColumns(first_active_column(keys)).withColumns(tenure_columns(keys))


def purchase_start_column(
    series: Sequence[str] = DEFAULT_PURCHASE_SERIES, keys: PanelKeys = YEARLY
) -> dict[str, Column]:
    starts = [
        F.when((F.lag(c, 1, 0).over(keys.ordered()) == 0) & (F.col(c) > 0), F.col(keys.period)) for c in series
    ]
    return {"ft_purchase_at_t_date": F.coalesce(*starts)}


def first_purchase_date(
    panel: DataFrame, series: Sequence[str] = DEFAULT_PURCHASE_SERIES, keys: PanelKeys = YEARLY
) -> DataFrame:
    """Period in which a running total first leaves 0 (first such series wins), carried down."""
    return fill(panel.withColumns(purchase_start_column(series, keys)), ["ft_purchase_at_t_date"], "down", keys)


def last_purchase_column(purchases: str = "to_sum_opps_won", keys: PanelKeys = YEARLY) -> dict[str, Column]:
    bought = F.when(F.col(purchases) > 0, F.col(keys.period))
    return {"lt_purchase_at_T_date": F.last(bought, ignorenulls=True).over(keys.history())}


def since_last_purchase_column(keys: PanelKeys = YEARLY) -> dict[str, Column]:
    """Needs ``lt_purchase_at_T_date``; looks at the purchase known one period before."""
    before = F.lag("lt_purchase_at_T_date", 1).over(keys.ordered())
    return {"duration_since_last_purchase": keys.distance(before)}


DURATIONS = {
    "ts_first_exploit_year": "exploit_duration_ft_purchase",
    "ts_first_explore_year": "explore_duration_ft_purchase",
    "ft_purchase_at_t_date": "customer_duration_ft_purchase",
}


def recency(panel: DataFrame, purchases: str = "to_sum_opps_won", keys: PanelKeys = YEARLY) -> DataFrame:
    """Last purchase so far, time since the one before, and durations since first purchases."""
    panel = panel.withColumns(last_purchase_column(purchases, keys)).withColumns(since_last_purchase_column(keys))
    present = {first: out for first, out in DURATIONS.items() if first in panel.columns}
    return periods_since(panel, present, default=0, keys=keys)


def treatment_columns(
    first: str = "ts_first_explore_year", base_year: int = C.DEFAULT_BASE_YEAR, keys: PanelKeys = YEARLY
) -> dict[str, Column]:
    treated_at = F.col(first)
    t = keys.distance(F.coalesce(treated_at, F.lit(base_year)))
    dummies: dict[str, Column] = {
        "post_period": t >= 0,
        "pre_treatment_3plus": t <= -3,
        "pre_treatment_2": t == -2,
        "pre_treatment_1": t == -1,
        "post_treatment_0": t == 0,
        "post_treatment_1": t == 1,
        "post_treatment_2": t == 2,
        "post_treatment_3plus": t >= 3,
    }
    return {
        "treatment": flag(yes(F.col(keys.period) >= treated_at)),
        "ever_treated": flag(treated_at.isNotNull()),
        "time_to_treat": t,
        **{name: flag(c) for name, c in dummies.items()},
    }


def treatment_features(
    panel: DataFrame,
    first: str = "ts_first_explore_year",
    base_year: int = C.DEFAULT_BASE_YEAR,
    keys: PanelKeys = YEARLY,
) -> DataFrame:
    """Treatment flag, event time and lead/lag dummies.

    Entities that are never treated count time from ``base_year``.
    """
    return panel.withColumns(treatment_columns(first, base_year, keys))


def value_at_event_column(
    column: str, out: str, event_time: str = "time_to_treat", keys: PanelKeys = YEARLY
) -> dict[str, Column]:
    return {out: F.max(F.when(F.col(event_time) == 0, F.col(column))).over(keys.whole())}


def value_at_event(
    panel: DataFrame, column: str, out: str, event_time: str = "time_to_treat", keys: PanelKeys = YEARLY
) -> DataFrame:
    """The column's value at event time 0, on every row of the entity."""
    return panel.withColumns(value_at_event_column(column, out, event_time, keys))


def suspicious_rows(
    country: str,
    won_value: str = "to_sum_val_opps_won",
    name: str = "customer_name",
    test_accounts: str = C.TEST_ACCOUNT_PATTERN,
) -> Column:
    """Implausible won values, test accounts, and activity without a first purchase."""
    won = F.col(won_value)
    return yes(
        ((won > 0) & (won <= C.TINY_VALUE))
        | ((F.col("country") == country) & (won > C.HUGE_VALUE))
        | matches(F.col(name), test_accounts)
        | (F.col("first_purchase_year").isNull() & (F.col("relationship_status") != C.PRE))
    )


def suspicious_entities(panel: DataFrame, country: str, keys: PanelKeys = YEARLY, **options) -> DataFrame:
    return panel.filter(suspicious_rows(country, **options)).select(keys.entity).distinct()


def finalise_panel(
    panel: DataFrame,
    lo: int,
    hi: int,
    country: str,
    keys: PanelKeys = YEARLY,
    keep_missing: Iterable[str] = EVENT_TIME_COLUMNS,
    **options,
) -> DataFrame:
    """Remove suspicious entities as a whole, apply the filters and zero active gaps.

    The entity verdict is a window maximum, so the panel is not joined to itself and NULL
    entities are judged like any other.
    """
    verdict = F.max(suspicious_rows(country, **options)).over(keys.whole())
    kept = (
        panel.withColumn("_suspicious", verdict)
        .filter(~F.col("_suspicious"))
        .drop("_suspicious")
        .filter(F.col(keys.period).between(lo, hi))
        .filter(F.col("country").isNull() | (F.col("country") == country))
        .filter(F.col("first_purchase_year").isNotNull())
    )
    keep = {*keep_missing, keys.entity, keys.period}
    numeric = [f for f in kept.schema if isinstance(f.dataType, NumericType) and f.name not in keep]
    gap_is_zero = "CASE WHEN relationship_status = '{active}' THEN coalesce(`{c}`, 0) ELSE `{c}` END"
    return kept.withColumns({f.name: F.expr(gap_is_zero.format(active=C.ACTIVE, c=f.name)) for f in numeric})
