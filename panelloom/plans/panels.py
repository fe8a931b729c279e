"""The two panel builds: the full event-study panel and the small count panel."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.config import PanelKeys, PanelSpec
from panelloom.operators import lifecycle as H
from panelloom.operators import measures as M
from panelloom.operators import panel as P
from panelloom.operators import windows as G
from panelloom.operators.schema import ids_as_string, resolve_roles


@dataclass(frozen=True)
class PanelInputs:
    """Cleaned datasets. Optional ones may be None; their measures are then left out.

    ``attributes`` is the table that describes entities (default: the opportunities), and
    ``order_by`` the total order in which its "first row" is meant.
    """

    opportunities: DataFrame
    customers: DataFrame | None = None
    attributes: DataFrame | None = None
    attributes_entity: str | None = None
    order_by: Sequence[str] = ("to_id",)
    software_sales: DataFrame | None = None
    meetings: DataFrame | None = None
    mails: DataFrame | None = None
    other_activities: DataFrame | None = None
    cases: DataFrame | None = None
    missions: DataFrame | None = None
    mission_entity: str | None = None
    installed_base: DataFrame | None = None
    registered_products: DataFrame | None = None


# Measures that are unknown before the relationship and 0 by default while active.
OPPORTUNITY_COLUMNS = (
    "to_number_of_opps",
    "to_sum_opps_closed",
    "to_sum_opps_won",
    "to_sum_val_opps_won",
    *[f"to_{kind}_{g}" for kind in ("closed", "value") for g in M.C.MEASURED_CATEGORY_GROUPS],
    "to_opp_winning_probability",
)
SOFTWARE_COLUMNS = (
    "ts_sales_sw_num_total",
    "ts_sales_total_sw",
    "ts_sales_num_sw_explore",
    "ts_sales_total_exploration",
    "ts_sales_num_sw_exploit",
    "ts_sales_total_exploitation",
)
SERVICE_COLUMNS = (
    "n_cases",
    "n_breakdowns",
    "n_complaints",
    "n_failures",
    "n_low_priority",
    "n_default_priority",
    "n_high_priority",
    "avg_reaction_time",
    "n_delayed_callbacks",
    "Low_service_dissatisfiers_sum",
    "Default_service_dissatisfiers_sum",
    "High_service_dissatisfiers_sum",
    "all_dissatisfaction",
    "n_missions",
    "avg_waiting_time",
    "avg_working_time",
    "n_delayed_missions",
)
INSTALLED_COLUMNS = ("installed_hw_power_bi", "n_equipment_types", "n_equipment_groups", "installed_hw_cum")
PRODUCT_COLUMNS = (
    "reg_prods_total",
    "ERP_Registered_Product",
    "Manual_Registered_Product",
    "Registered_Competitor_Product",
)

MEASURED_COLUMNS = (
    *OPPORTUNITY_COLUMNS,
    *SOFTWARE_COLUMNS,
    *M.ACTIVITY_COLUMNS,
    *SERVICE_COLUMNS,
    *INSTALLED_COLUMNS,
    *PRODUCT_COLUMNS,
)


def entity_grid(inputs: PanelInputs, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    """The entity x period grid with attributes, and the entity attributes themselves.

    Attributes join the entity list before it is spread over the periods.
    """
    keys = spec.keys
    roles = resolve_roles(inputs.opportunities, "opportunities", ["entity"])
    start = F.col(roles["start_period"]) if "start_period" in roles else F.year(roles["start"])
    lo = spec.first_period - spec.lead_in
    firsts = P.first_event(inputs.opportunities, roles["entity"], start.cast("long"), lo, spec.last_period, keys)
    described = inputs.opportunities if inputs.attributes is None else inputs.attributes
    attributes = P.attributes_from(described, inputs.attributes_entity or roles["entity"], inputs.order_by, keys)
    if inputs.customers is not None:
        attributes = P.add_secondary_id(attributes, inputs.customers, keys)
    return P.base_panel(P.add_attributes(firsts, attributes, keys), lo, spec.last_period, keys), attributes


def measure_tables(inputs: PanelInputs, attributes: DataFrame, spec: PanelSpec) -> list[DataFrame]:
    """All measure tables, keyed by (entity, period).

    Sources keyed by the secondary id or by name are moved to the entity key here. Every period of
    the grid is known, so rows without one are left out; tables that count the same source then differ
    in their aggregates only, and where these are not asked for Spark shuffles such tables once.
    """
    keys = spec.keys
    by_sap_id = "customer_sap_id" in attributes.columns

    def rekeyed(table: DataFrame, column: str, wanted: bool) -> DataFrame:
        return P.rekey_measures(table, attributes, column, keys) if wanted else table

    tables = [M.first_years(M.opportunity_measures(inputs.opportunities, spec.categories, keys=keys), keys)]
    if inputs.software_sales is not None:
        sales = M.software_measures(inputs.software_sales, spec.exploration_pattern, spec.exploitation_pattern, keys)
        tables.append(rekeyed(sales, "customer_sap_id", by_sap_id))
    if inputs.meetings is not None:
        tables.append(M.meeting_measures(inputs.meetings, keys))
    if inputs.mails is not None:
        tables.append(M.mail_measures(inputs.mails, keys))
    if inputs.other_activities is not None:
        others = M.other_activity_measures(inputs.other_activities, keys)
        tables.append(rekeyed(others, "customer_name", "customer_name" in attributes.columns))
    if inputs.cases is not None:
        tables.append(rekeyed(M.case_measures(inputs.cases, keys=keys), "customer_sap_id", by_sap_id))
    if inputs.missions is not None:
        tables.append(M.mission_measures(inputs.missions, inputs.mission_entity, keys))
    if inputs.installed_base is not None:
        tables.append(rekeyed(M.installed_base_measures(inputs.installed_base, keys), "customer_sap_id", by_sap_id))
    if inputs.registered_products is not None:
        tables.append(M.registered_product_measures(inputs.registered_products, spec.registered_product_cap, keys))
    return [t.filter(F.col(keys.period).isNotNull()) for t in tables]


def software_features(panel: DataFrame, keys: PanelKeys = PanelKeys()) -> DataFrame:
    """Running totals, first years, ever and post flags and years since, per software class."""
    windows = G.cumulative_columns({c: f"{c}_cum" for c in SOFTWARE_COLUMNS}, keys)
    windows |= G.first_period_columns(_software_firsts(), keys)
    return panel.withColumns(windows).withColumns(_software_followups(keys))


def _software_firsts() -> dict[str, Column]:
    return {
        "ts_first_any_sw_year": F.col("ts_sales_sw_num_total") > 0,
        "ts_first_explore_year": F.col("ts_sales_num_sw_explore") > 0,
        "ts_first_exploit_year": F.col("ts_sales_num_sw_exploit") > 0,
    }


def _software_followups(keys: PanelKeys) -> dict[str, Column]:
    flags = {
        "ts_first_any_sw_year": ("ts_ever_purchased_sw", "ts_post_any_sw_period"),
        "ts_first_explore_year": ("ts_ever_purchased_explore", "ts_post_explore_period"),
        "ts_first_exploit_year": ("ts_ever_purchased_exploit", "ts_post_exploit_period"),
    }
    since = {
        "ts_first_any_sw_year": "ts_years_since_any_sw",
        "ts_first_explore_year": "ts_years_since_explore",
        "ts_first_exploit_year": "ts_years_since_exploit",
    }
    return G.ever_and_post_columns(flags, keys) | G.periods_since_columns(since, keys=keys)


OPPORTUNITY_TOTALS = {
    "to_number_of_opps": "to_cum_opps",
    "to_sum_opps_won": "to_cum_opps_won",
    "to_sum_val_opps_won": "to_cum_val_opps_won",
    "to_value_accessories": "to_cum_value_accessories",
    "to_value_hw_mt_standalone": "to_cum_value_hw_mt",
    "to_value_hw_lt_standalone": "to_cum_value_hw_lt",
    "to_value_software": "to_cum_value_software",
    "to_value_services": "to_cum_value_services",
}
PRODUCT_TOTALS = {
    "reg_prods_total": "reg_prods_total_cum",
    "ERP_Registered_Product": "erp_registered_product_cum",
    "Manual_Registered_Product": "Manual_Registered_Product_cum",
    "Registered_Competitor_Product": "Registered_Competitor_Product_cum",
}


def product_features(panel: DataFrame, keys: PanelKeys = PanelKeys()) -> DataFrame:
    """Running totals, purchase shares and five-period means of registered products."""
    windows = G.cumulative_columns(PRODUCT_TOTALS, keys)
    windows |= G.rolling_columns({"reg_prods_total": "reg_prods_total_ra_5"}, 5, keys)
    panel = M.share_measures(panel.withColumns(windows))
    return G.rolling_mean(panel, {"share_of_purchase_T_cum": "share_of_purchase_T_cum_ra_5"}, 5, keys)


def feature_panel(inputs: PanelInputs, spec: PanelSpec) -> DataFrame:
    """The panel with every feature, before suspicious entities and filters are applied.

    After ``align_measures`` the rows are hashed by entity, so no feature below needs
    another exchange. Features are grouped by what they depend on: each group of window
    features is one ``withColumns`` and thereby one Window operator over the same sort.
    """
    keys = spec.keys
    grid, attributes = entity_grid(inputs, spec)
    panel = P.align_measures(grid, measure_tables(inputs, attributes, spec), keys)
    software, products = inputs.software_sales is not None, inputs.registered_products is not None
    cases = inputs.cases is not None
    activities = any(d is not None for d in (inputs.meetings, inputs.mails, inputs.other_activities))
    if activities:
        panel = M.ensure_columns(panel, M.ACTIVITY_COLUMNS)
    panel = P.mask_inactive(panel, [c for c in MEASURED_COLUMNS if c in panel.columns])

    # Row by row.
    if activities:
        panel = M.activity_sums(panel)
    if cases:
        panel = M.service_ratios(panel)

    # Windows over measures.
    first = G.cumulative_columns(OPPORTUNITY_TOTALS, keys)
    first |= G.first_period_columns({"first_opp_year": F.col("to_number_of_opps") > 0}, keys)
    rolling = {"to_number_of_opps": "to_rolling_opps_3yr", "to_sum_val_opps_won": "to_rolling_value_3yr"}
    first |= G.rolling_columns(rolling, 3, keys, null_as_zero=True)
    first |= H.first_active_column(keys) | H.last_purchase_column(keys=keys)
    if software:
        first |= G.cumulative_columns({c: f"{c}_cum" for c in SOFTWARE_COLUMNS}, keys)
        first |= G.first_period_columns(_software_firsts(), keys)
    if activities:
        rolling = {"aggregated_sales_act": "rolling_interactions_3yr", "effort_to_revenue_ratio": "rolling_efforts_3yr"}
        first |= G.rolling_columns(rolling, 3, keys) | M.lagged_effort_column(panel, "to_sum_val_opps_won", keys)
    if cases:
        dissatisfied = ("High_service_dissatisfiers_sum", "all_dissatisfaction")
        first |= G.rolling_columns({c: f"{c}_ra_5" for c in dissatisfied}, 5, keys)
    if products:
        first |= G.cumulative_columns(PRODUCT_TOTALS, keys)
        first |= G.rolling_columns({"reg_prods_total": "reg_prods_total_ra_5"}, 5, keys)
    panel = panel.withColumns(first)

    # Row by row again.
    follow = H.tenure_columns(keys) | G.periods_since_columns({"first_opp_year": "years_since_first_opp"}, keys=keys)
    if software:
        follow |= _software_followups(keys) | H.treatment_columns(base_year=spec.base_year, keys=keys)
    panel = panel.withColumns(follow)
    if products:
        panel = M.share_measures(panel)

    # Windows over the features so far.
    second = H.purchase_start_column(H.DEFAULT_PURCHASE_SERIES if products else ["to_cum_opps_won"], keys)
    second |= H.since_last_purchase_column(keys)
    if software:
        second |= H.value_at_event_column("customer_tenure", "customer_relationship_length_at_treatment", keys=keys)
    if products:
        second |= G.rolling_columns({"share_of_purchase_T_cum": "share_of_purchase_T_cum_ra_5"}, 5, keys)
    panel = G.fill(panel.withColumns(second), ["ft_purchase_at_t_date"], "down", keys)
    present = {first_year: out for first_year, out in H.DURATIONS.items() if first_year in panel.columns}
    return G.periods_since(panel, present, default=0, keys=keys)


def build_panel(inputs: PanelInputs, spec: PanelSpec) -> DataFrame:
    """The finished panel: every feature, suspicious entities removed, filters applied."""
    panel = feature_panel(inputs, spec)
    # The filters need both columns; an undescribed entity has neither.
    missing = [c for c in ("country", "customer_name") if c not in panel.columns]
    return H.finalise_panel(
        panel.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else panel,
        spec.first_period,
        spec.last_period,
        spec.country,
        spec.keys,
        test_accounts=spec.test_account_pattern,
    )


def build_simple_panel(
    firsts: DataFrame,
    attributes: DataFrame | None,
    counts: Sequence[DataFrame],
    lo: int,
    hi: int,
    keys: PanelKeys = PanelKeys(),
    running: dict[str, str] | None = None,
) -> DataFrame:
    """Grid, attributes and yearly counts with 0 for "no record".

    ``running`` names count columns that also get a dense running total.
    """
    entities = firsts if attributes is None else P.add_attributes(firsts, attributes, keys)
    panel = P.align_measures(P.base_panel(entities, lo, hi, keys), counts, keys)
    columns = [c for t in counts for c in t.columns if c not in (keys.entity, keys.period)]
    panel = P.zero_missing(panel, columns)
    return G.cumulative(panel, running, keys) if running else panel


def yearly(column: str) -> Column:
    return F.year(column).cast("long")


def with_text_ids(inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Ids as text in every dataset, so that extracts with differing types join."""
    return {name: ids_as_string(df) for name, df in inputs.items()}
