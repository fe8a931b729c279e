"""Yearly measure tables: one row per (entity, period).

Each measure table is one conditional aggregation over its source. Spark aggregates
partially before the shuffle, so an entity with a third of all source rows sends one row
per task and period. Nothing is repartitioned by entity before that.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from panelloom import config as C
from panelloom.config import PanelKeys
from panelloom.functions.logic import (
    contains_text,
    count_rows,
    count_where,
    is_one_of,
    matches,
    ratio,
    sum_or_zero,
    sum_where,
)
from panelloom.operators.schema import ensure_columns, resolve_roles

YEARLY = PanelKeys()


def aggregate_by_period(
    df: DataFrame, entity: Column, period: Column, aggregates: Mapping[str, Column], keys: PanelKeys = YEARLY
) -> DataFrame:
    """The shared shape of every measure table."""
    return df.groupBy(entity.alias(keys.entity), period.alias(keys.period)).agg(
        *[value.alias(name) for name, value in aggregates.items()]
    )


def _year_from(df: DataFrame, roles: Mapping[str, str], date_role: str) -> Column:
    """The period column, or the year of a date column when the period is absent."""
    if "period" in roles:
        return F.col(roles["period"]).cast("long")
    if date_role in roles:
        return F.year(roles[date_role]).cast("long")
    raise ValueError(f"neither a period nor a {date_role} column; available: {df.columns}")


# --------------------------------------------------------------------------
# Sales
# --------------------------------------------------------------------------


def opportunity_measures(
    opportunities: DataFrame,
    categories: Mapping[str, Sequence[str]] | DataFrame | None = None,
    closed: Sequence[str] = C.CLOSED_STATUSES,
    closed_by_category: Sequence[str] = C.CLOSED_STATUSES_BY_CATEGORY,
    keys: PanelKeys = YEARLY,
) -> DataFrame:
    """Counts, won value and win rate per entity and closing period, overall and per category group.

    ``categories`` holds a list per group, or is a ``category_map`` table that is joined.
    """
    categories = C.DEFAULT_CATEGORIES if categories is None else categories
    roles = resolve_roles(opportunities, "opportunities", ["entity", "status", "category", "value"])
    status, category, value = (F.col(roles[r]) for r in ("status", "category", "value"))
    won = status == C.WON
    if isinstance(categories, DataFrame):
        opportunities = tag_category_groups(opportunities, roles["category"], categories)
        in_group = {
            out: F.coalesce(F.array_contains("_groups", g), F.lit(False)) for out, g in C.MEASURED_CATEGORY_GROUPS.items()
        }
    else:
        in_group = {out: is_one_of(category, categories.get(g, ())) for out, g in C.MEASURED_CATEGORY_GROUPS.items()}
    n_closed, n_won = count_where(is_one_of(status, closed)), count_where(won)
    return aggregate_by_period(
        opportunities,
        F.col(roles["entity"]),
        _year_from(opportunities, roles, "close_date"),
        {
            "to_number_of_opps": count_rows(),
            "to_sum_opps_closed": n_closed,
            "to_sum_opps_won": n_won,
            "to_sum_val_opps_won": sum_where(won, value),
            **{f"to_closed_{g}": count_where(hit & is_one_of(status, closed_by_category)) for g, hit in in_group.items()},
            **{f"to_value_{g}": sum_where(hit & won, value) for g, hit in in_group.items()},
            "to_opp_winning_probability": ratio(n_won.cast("double"), n_closed),
        },
        keys,
    )


def first_years(measures: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """First year with a win, with hardware value and with software value (per entity)."""
    hardware = F.col("to_value_hw_mt_standalone") + F.col("to_value_hw_lt_standalone")
    conditions = {
        "to_first_purchase_year": F.col("to_sum_opps_won") > 0,
        "to_hw_purchase_year": hardware > 0,
        "to_sw_purchase_year": F.col("to_value_software") > 0,
    }
    period = F.col(keys.period)
    return measures.withColumns({out: F.min(F.when(c, period)).over(keys.whole()) for out, c in conditions.items()})


def software_measures(
    sales: DataFrame,
    exploration: str = C.EXPLORATION_PATTERN,
    exploitation: str = C.EXPLOITATION_PATTERN,
    keys: PanelKeys = YEARLY,
) -> DataFrame:
    """Number and revenue of software sales, in total and per class of product text."""
    roles = resolve_roles(sales, "software_sales", ["entity", "period", "generation", "revenue"])
    revenue, product = F.col(roles["revenue"]), F.col(roles["generation"])
    explore, exploit = matches(product, exploration), matches(product, exploitation)
    return aggregate_by_period(
        sales,
        F.col(roles["entity"]),
        F.col(roles["period"]),
        {
            "ts_sales_sw_num_total": count_rows(),
            "ts_sales_total_sw": sum_or_zero(revenue),
            "ts_sales_num_sw_explore": count_where(explore),
            "ts_sales_total_exploration": sum_where(explore, revenue),
            "ts_sales_num_sw_exploit": count_where(exploit),
            "ts_sales_total_exploitation": sum_where(exploit, revenue),
        },
        keys,
    )


def software_flags(
    sales: DataFrame,
    entity: str,
    date: str,
    category: str,
    product: str,
    categories: Sequence[str],
    exploration: str = C.EXPLORATION_PATTERN,
    exploitation: str = C.EXPLOITATION_PATTERN,
    keys: PanelKeys = YEARLY,
) -> DataFrame:
    """Whether a period saw software of either class (category in list and text matches)."""
    software = is_one_of(F.col(category), categories)
    return aggregate_by_period(
        sales,
        F.col(entity),
        F.year(date).cast("long"),
        {
            "has_exploration": F.max((software & matches(F.col(product), exploration)).cast("long")),
            "has_exploitation": F.max((software & matches(F.col(product), exploitation)).cast("long")),
        },
        keys,
    )


# --------------------------------------------------------------------------
# Activities
# --------------------------------------------------------------------------


def count_by_source(
    sources: Mapping[str, tuple[DataFrame, str, Column]], prefix: str = "n_", keys: PanelKeys = YEARLY
) -> DataFrame:
    """Rows per source, entity and period, for any number of sources in one aggregation.

    ``sources`` maps a label to (table, entity column, period expression). The sources are
    stacked with a label and counted conditionally: one shuffle instead of one join each.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [
            df.select(F.col(entity).alias(keys.entity), period.alias(keys.period), F.lit(label).alias("_source"))
            for label, (df, entity, period) in sources.items()
        ],
    )
    counts = {f"{prefix}{label}": count_where(F.col("_source") == label) for label in sources}
    return aggregate_by_period(stacked, F.col(keys.entity), F.col(keys.period), counts, keys)


def interaction_counts(sources: Mapping[str, tuple[DataFrame, str, Column]], keys: PanelKeys = YEARLY) -> DataFrame:
    """Opportunities, quotes, meetings, mails and other activities per entity and period."""
    return count_by_source(sources, keys=keys)


def service_counts(sources: Mapping[str, tuple[DataFrame, str, Column]], keys: PanelKeys = YEARLY) -> DataFrame:
    """Cases and missions per entity and period."""
    return count_by_source(sources, keys=keys)


def _known(df: DataFrame, *columns: str) -> DataFrame:
    return reduce(lambda d, c: d.filter(F.col(c).isNotNull()), columns, df)


def meeting_measures(meetings: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """Completed meetings and total minutes; optional columns may be absent."""
    roles = resolve_roles(meetings, "meetings", ["entity", "period"])
    completed = count_where(F.col(roles["status"]) == "Completed") if "status" in roles else count_rows()
    minutes = sum_or_zero(F.col(roles["duration"])) if "duration" in roles else F.max(F.lit(0.0))
    return aggregate_by_period(
        _known(meetings, roles["entity"], roles["period"]),
        F.col(roles["entity"]),
        F.col(roles["period"]),
        {"completed_meetings_num_total": completed, "total_meeting_duration": minutes},
        keys,
    )


def mail_measures(mails: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """Mails in total and per priority class."""
    roles = resolve_roles(mails, "mails", ["entity"])
    groups = {"high": C.HIGH_PRIORITIES, "normal": C.NORMAL_PRIORITIES, "low": C.LOW_PRIORITIES}
    priority = F.col(roles["priority"]) if "priority" in roles else F.lit(None).cast("string")
    period = F.col(roles["period"]) if "period" in roles else _year_from(mails, roles, "sent_on")
    return aggregate_by_period(
        _known(mails, roles["entity"]).filter(period.isNotNull()),
        F.col(roles["entity"]),
        period,
        {
            "mails_total": count_rows(),
            **{f"mails_{g}_priority": count_where(is_one_of(priority, names)) for g, names in groups.items()},
        },
        keys,
    )


def other_activity_measures(activities: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """Activities in total and by kind, recognised by a text they contain."""
    roles = resolve_roles(activities, "other_activities", ["entity", "period"])
    kinds = {"phone_calls": "Phone Call", "letters": "Letter", "faxes": "Fax"}
    kind = F.col(roles["activity_type"]) if "activity_type" in roles else F.lit(None).cast("string")
    return aggregate_by_period(
        _known(activities, roles["period"]),
        F.col(roles["entity"]),
        F.col(roles["period"]),
        {
            "other_act_total": count_rows(),
            **{f"other_act_{out}": count_where(contains_text(kind, text)) for out, text in kinds.items()},
        },
        keys,
    )


ACTIVITY_COLUMNS = (
    "completed_meetings_num_total",
    "total_meeting_duration",
    "mails_total",
    "mails_high_priority",
    "mails_normal_priority",
    "mails_low_priority",
    "other_act_total",
    "other_act_phone_calls",
    "other_act_letters",
    "other_act_faxes",
)


def activity_totals(panel: DataFrame, won_value: str = "to_sum_val_opps_won", keys: PanelKeys = YEARLY) -> DataFrame:
    """Synchronous, asynchronous and all activities, and effort per revenue (now and lagged)."""
    panel = activity_sums(panel, won_value)
    return panel.withColumns(lagged_effort_column(panel, won_value, keys))


def activity_sums(panel: DataFrame, won_value: str = "to_sum_val_opps_won") -> DataFrame:
    """The part of ``activity_totals`` that needs no neighbouring period."""
    panel = ensure_columns(panel, ACTIVITY_COLUMNS)

    def total(*columns: str) -> Column:
        return sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))

    synchronous = total("completed_meetings_num_total", "other_act_phone_calls")
    asynchronous = total("mails_total", "other_act_letters", "other_act_faxes")
    everything = synchronous + asynchronous
    return panel.withColumns(
        {
            "sales_act_synchronous": synchronous,
            "sales_act_asynchronous": asynchronous,
            "aggregated_sales_act": everything,
            "effort_to_revenue_ratio": 1000 * everything / _revenue(won_value)
            if won_value in panel.columns
            else F.lit(0.0),
        }
    )


def lagged_effort_column(panel: DataFrame, won_value: str, keys: PanelKeys = YEARLY) -> dict[str, Column]:
    """Last period's activities per this period's revenue."""
    previous = F.lag("aggregated_sales_act", 1).over(keys.ordered())
    ratio_now = 1000 * previous / _revenue(won_value) if won_value in panel.columns else F.lit(0.0)
    return {"lagged_effort_to_revenue_ratio": ratio_now}


def _revenue(won_value: str) -> Column:
    won = F.col(won_value)
    return F.when(won > 0, won).when(won.isNotNull(), 1.0)  # unknown stays unknown


# --------------------------------------------------------------------------
# Service
# --------------------------------------------------------------------------


def case_measures(
    cases: DataFrame, dissatisfiers: Sequence[str] = C.DISSATISFIER_TYPES, keys: PanelKeys = YEARLY
) -> DataFrame:
    """Service cases by type and priority, reaction time, late callbacks and dissatisfiers."""
    roles = resolve_roles(cases, "cases", ["entity", "period"])

    def column(role: str, kind: str) -> Column:
        return F.col(roles[role]) if role in roles else F.lit(None).cast(kind)

    case_type, priority = column("case_type", "string"), column("priority", "string")
    levels = ("Low", "Default", "High")
    unhappy = is_one_of(case_type, dissatisfiers)
    table = aggregate_by_period(
        _known(cases, roles["period"]),
        F.col(roles["entity"]),
        F.col(roles["period"]),
        {
            "n_cases": count_rows(),
            "n_breakdowns": count_where(case_type == "Breakdown"),
            "n_complaints": count_where(case_type == "Complaint"),
            "n_failures": count_where(case_type == "Failure"),
            **{f"n_{p.lower()}_priority": count_where(priority == p) for p in levels},
            "avg_reaction_time": F.avg(column("reaction_time", "double")),
            "n_delayed_callbacks": count_where(column("delayed_callbacks", "double") > 0),
            **{f"{p}_service_dissatisfiers_sum": count_where(unhappy & (priority == p)) for p in levels},
        },
        keys,
    )
    return table.withColumn("all_dissatisfaction", sum((F.col(f"{p}_service_dissatisfiers_sum") for p in levels), F.lit(0)))


def mission_measures(missions: DataFrame, entity: str | None = None, keys: PanelKeys = YEARLY) -> DataFrame:
    """Missions, mean waiting and working time and delays.

    ``entity`` names the customer column; by default the mission id itself is the key.
    The delay column may hold text or a boolean.
    """
    roles = resolve_roles(missions, "missions", ["period"] if entity else ["entity", "period"])
    delayed = F.lit(False)
    if "delayed" in roles:
        kind = next(f.dataType for f in missions.schema if f.name == roles["delayed"])
        if isinstance(kind, BooleanType):
            delayed = F.col(roles["delayed"])
        elif isinstance(kind, StringType):
            delayed = F.col(roles["delayed"]) == "Mission delayed"
        else:
            delayed = F.col(roles["delayed"]) > 0

    def mean(role: str) -> Column:
        return F.avg(roles[role]) if role in roles else F.avg(F.lit(None).cast("double"))

    return aggregate_by_period(
        _known(missions, roles["period"]),
        F.col(entity or roles["entity"]),
        F.col(roles["period"]),
        {
            "n_missions": count_rows(),
            "avg_waiting_time": mean("waiting_time"),
            "avg_working_time": mean("working_time"),
            "n_delayed_missions": count_where(delayed),
        },
        keys,
    )


def service_ratios(panel: DataFrame, tenure: str | None = None) -> DataFrame:
    """Cases per tenure (or plain cases without a tenure column) and problems per case."""
    cases = F.col("n_cases").cast("double")
    problems = F.col("n_breakdowns") + F.col("n_complaints") + F.col("n_failures")
    return panel.withColumns(
        {
            "service_case_intensity": cases / F.coalesce(F.nullif(F.col(tenure), F.lit(0)), F.lit(1)) if tenure else cases,
            "service_problem_intensity": problems / F.when(cases > 0, cases).otherwise(1.0),
        }
    )


# --------------------------------------------------------------------------
# Installed base and registered products
# --------------------------------------------------------------------------


def installed_base_measures(installed: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """Units, distinct types and groups, and a running total over the observed periods."""
    roles = resolve_roles(installed, "installed_base", ["entity", "period"])

    # Sets of types and groups, reduced in each task: one shuffle, and a hot entity sends a set per task.
    kinds = {r: F.col(roles[r]) if r in roles else F.lit(1) for r in ("equipment_type", "equipment_group")}
    table = aggregate_by_period(
        _known(installed, roles["period"]),
        F.col(roles["entity"]),
        F.col(roles["period"]),
        {
            "installed_hw_power_bi": count_rows(),
            **{
                name: F.size(F.collect_set(kinds[r])).cast("long")
                for r, name in (("equipment_type", "n_equipment_types"), ("equipment_group", "n_equipment_groups"))
            },
        },
        keys,
    )
    return table.withColumn("installed_hw_cum", F.sum("installed_hw_power_bi").over(keys.history()))


def machine_counts(
    installed: DataFrame, entity: str, date: str, serial: str = "serial_number", keys: PanelKeys = YEARLY
) -> DataFrame:
    """Distinct machines delivered per entity and period."""
    return aggregate_by_period(
        installed,
        F.col(entity),
        F.year(date).cast("long"),
        {"n_machines_installed": F.count_distinct(serial)},
        keys,
    )


def registered_product_measures(
    products: DataFrame, cap: int | None = None, keys: PanelKeys = YEARLY
) -> DataFrame:
    """Registered products in total and by registration kind; with a ``cap``, up to that year."""
    roles = resolve_roles(products, "registered_products", ["entity", "period"])
    kind = F.col(roles["category"]) if "category" in roles else F.lit(None).cast("string")
    texts = ("ERP Registered Product", "Manual Registered Product", "Registered Competitor Product")
    return aggregate_by_period(
        products if cap is None else products.filter(F.col(roles["period"]) <= cap),
        F.col(roles["entity"]),
        F.col(roles["period"]),
        {
            "reg_prods_total": count_rows(),
            **{text.replace(" ", "_"): count_where(contains_text(kind, text)) for text in texts},
        },
        keys,
    )


def share_measures(panel: DataFrame) -> DataFrame:
    """Own and competitor share of registered products, in the period and cumulative."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    own = filled("ERP_Registered_Product") + filled("Manual_Registered_Product")
    own_cum = F.col("erp_registered_product_cum") + F.col("Manual_Registered_Product_cum")
    total, total_cum = F.col("reg_prods_total"), F.col("reg_prods_total_cum")
    # An unknown total (pre-relationship) has an unknown share, not a zero one.
    in_year = F.when(total.isNotNull(), F.lit(1.0))
    return panel.withColumns(
        {
            "all_T_reg_products_in_year": own,
            "share_of_purchase_T_in_year": in_year * ratio(own, total),
            "share_of_purchase_competitor_in_year": in_year * ratio(filled("Registered_Competitor_Product"), total),
            "all_T_reg_products_cum": own_cum,
            "share_of_purchase_T_cum": ratio(own_cum, total_cum),
            "share_of_purchase_competitor_cum": ratio(F.col("Registered_Competitor_Product_cum"), total_cum),
        }
    )


# --------------------------------------------------------------------------
# Category dictionary
# --------------------------------------------------------------------------


def category_map(sources: Mapping[str, tuple[DataFrame, str]], fallback: Mapping[str, Iterable[str]] | None = None):
    """``(category_group, category)`` without duplicates from per-group tables plus constants."""
    parts = [
        df.select(F.lit(group).alias("category_group"), F.col(column).alias("category"))
        for group, (df, column) in sources.items()
    ]
    rows = [(g, c) for g, names in (fallback or {}).items() for c in names]
    if rows:
        spark = next(iter(sources.values()))[0].sparkSession
        parts.append(spark.createDataFrame(rows, "category_group string, category string"))
    return reduce(DataFrame.unionByName, parts).distinct()


#: Categories that are broadcast at most; a longer dictionary is joined by a shuffle.
SMALL_DICTIONARY = 10_000


def tag_category_groups(df: DataFrame, column: str, categories: DataFrame) -> DataFrame:
    """Add ``_groups``: the category groups a row's category belongs to (no fan-out).

    A dictionary of checked size is broadcast: rows would crowd on a handful of categories.
    """
    groups = categories.groupBy(F.col("category").alias(column)).agg(F.collect_set("category_group").alias("_groups"))
    small = len(groups.select(column).take(SMALL_DICTIONARY + 1)) <= SMALL_DICTIONARY
    return df.join(F.broadcast(groups) if small else groups, column, "left")
