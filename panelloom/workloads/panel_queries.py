"""Panel construction, measure tables, window and lifecycle features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.config import PanelKeys, PanelSpec
from panelloom.operators import lifecycle as H
from panelloom.operators import measures as M
from panelloom.operators import panel as P
from panelloom.operators import windows as G
from panelloom.plans import panels
from panelloom.workloads.fixtures import Tables
from panelloom.workloads.registry import cte, query

LO, HI = 1995, 2001
DAILY = PanelKeys("account_id", "day", "day")
EXPLORE, EXPLOIT = "promo|economy|small", "standard"
RARE_EXPLORE = "promo brand#1 1[0-9]$"  # leaves many customers untreated
BASE_YEAR = 1998

# --------------------------------------------------------------------------
# Grid and attributes
# --------------------------------------------------------------------------

cte(
    "firsts",
    """SELECT to_customer_id AS customer_id, min(year(to_start_date)) AS first_interaction
       FROM v_opportunities GROUP BY 1 HAVING min(year(to_start_date)) BETWEEN 1985 AND 2006""",
)
cte(
    "grid",
    """SELECT customer_id, year, first_interaction,
              CASE WHEN year < first_interaction THEN 'pre_relationship' ELSE 'active' END AS relationship_status
       FROM firsts CROSS JOIN (SELECT unnest(range(1995, 2002)) AS year)""",
)


def firsts(t: Tables) -> DataFrame:
    opportunities = t.view("v_opportunities")
    return P.first_event(opportunities, "to_customer_id", F.year("to_start_date").cast("long"), LO, HI)


def grid(t: Tables) -> DataFrame:
    return P.base_panel(firsts(t), LO, HI)


@query("first_interaction", "customer_id:long first_interaction:long", "SELECT * FROM firsts")
def first_interaction(t):
    return firsts(t)


@query(
    "base_panel",
    "customer_id:long year:long first_interaction:long relationship_status:text",
    "SELECT * FROM grid",
)
def base_panel(t):
    return grid(t)


@query(
    "base_panel_daily",
    "account_id:long day:date first_interaction:date relationship_status:text",
    """WITH f AS (SELECT account_id, min(day) AS first_interaction FROM v_activities GROUP BY 1)
       SELECT account_id, CAST(d AS DATE) AS day, first_interaction,
              CASE WHEN CAST(d AS DATE) < first_interaction THEN 'pre_relationship' ELSE 'active' END AS relationship_status
       FROM f CROSS JOIN (SELECT unnest(range(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS d)
       WHERE first_interaction BETWEEN DATE '2023-12-22' AND DATE '2024-02-04'""",
)
def base_panel_daily(t):
    events = t.view("v_activities")
    first = P.first_event(events, "account_id", "day", "2024-01-01", "2024-01-30", DAILY)
    return P.base_panel(first, "2024-01-01", "2024-01-30", DAILY)


@query(
    "panel_attributes",
    "customer_id:long year:long relationship_status:text customer_name:text main_sector:text abc_classification:text"
    " country:text customer_sap_id:text",
    "SELECT * FROM grid LEFT JOIN v_customers USING (customer_id)",
)
def panel_attributes(t):
    customers = t.view("v_customers")
    attributes = P.attributes_from(customers, "customer_id", ["customer_id"])
    entities = P.add_attributes(firsts(t), P.add_secondary_id(attributes, customers))
    return P.base_panel(entities, LO, HI)


# --------------------------------------------------------------------------
# Sales
# --------------------------------------------------------------------------

_GROUPS = {
    "accessories": "Accessories",
    "hw_mt_standalone": "Punching machine",
    "hw_lt_standalone": "Laser machine",
    "software": "Software",
    "services": "Service",
}
OPP_SHAPE = (
    "customer_id:long year:long to_number_of_opps:long to_sum_opps_closed:long to_sum_opps_won:long"
    " to_sum_val_opps_won:money "
    + " ".join(f"to_closed_{g}:long to_value_{g}:money" for g in _GROUPS)
    + " to_opp_winning_probability:ratio"
)
cte(
    "opp",
    """SELECT to_customer_id AS customer_id, year(to_close_date) AS year, count(*) AS to_number_of_opps,
              count(*) FILTER (to_opportunity_status IN ('Won', 'Lost', 'Lost (autom.)', 'Not realized')) AS to_sum_opps_closed,
              count(*) FILTER (to_opportunity_status = 'Won') AS to_sum_opps_won,
              sum(CASE WHEN to_opportunity_status = 'Won' THEN to_expected_value ELSE 0 END) AS to_sum_val_opps_won, """
    + ", ".join(
        f"""count(*) FILTER (to_product_category = '{c}' AND to_opportunity_status IN ('Won', 'Lost', 'Not realized')) AS to_closed_{g},
            sum(CASE WHEN to_product_category = '{c}' AND to_opportunity_status = 'Won' THEN to_expected_value ELSE 0 END) AS to_value_{g}"""
        for g, c in _GROUPS.items()
    )
    + """, CASE WHEN count(*) FILTER (to_opportunity_status <> 'Open') = 0 THEN 0.0
              ELSE count(*) FILTER (to_opportunity_status = 'Won') / CAST(count(*) FILTER (to_opportunity_status <> 'Open') AS DOUBLE)
              END AS to_opp_winning_probability
       FROM v_opportunities GROUP BY 1, 2""",
)


def opportunity_table(t: Tables) -> DataFrame:
    return M.opportunity_measures(t.view("v_opportunities"))


@query("opportunity_yearly", OPP_SHAPE, "SELECT * FROM opp")
def opportunity_yearly(t):
    return opportunity_table(t)


@query(
    "first_purchase_years",
    "customer_id:long year:long to_first_purchase_year:long to_hw_purchase_year:long to_sw_purchase_year:long",
    """SELECT customer_id, year,
              min(CASE WHEN to_sum_opps_won > 0 THEN year END) OVER w AS to_first_purchase_year,
              min(CASE WHEN to_value_hw_mt_standalone + to_value_hw_lt_standalone > 0 THEN year END) OVER w AS to_hw_purchase_year,
              min(CASE WHEN to_value_software > 0 THEN year END) OVER w AS to_sw_purchase_year
       FROM opp WINDOW w AS (PARTITION BY customer_id)""",
)
def first_purchase_years(t):
    return M.first_years(opportunity_table(t))


SW_SHAPE = (
    "customer_id:long year:long ts_sales_sw_num_total:long ts_sales_total_sw:money ts_sales_num_sw_explore:long"
    " ts_sales_total_exploration:money ts_sales_num_sw_exploit:long ts_sales_total_exploitation:money"
)
_SW_SQL = """SELECT ts_customer_id AS customer_id, ts_year AS year, count(*) AS ts_sales_sw_num_total,
              sum(ts_revenue) AS ts_sales_total_sw,
              count(*) FILTER (regexp_matches(ts_generation, '(?i){explore}')) AS ts_sales_num_sw_explore,
              coalesce(sum(ts_revenue) FILTER (regexp_matches(ts_generation, '(?i){explore}')), 0) AS ts_sales_total_exploration,
              count(*) FILTER (regexp_matches(ts_generation, '(?i)standard')) AS ts_sales_num_sw_exploit,
              coalesce(sum(ts_revenue) FILTER (regexp_matches(ts_generation, '(?i)standard')), 0) AS ts_sales_total_exploitation
       FROM {view} GROUP BY 1, 2"""
cte("sw", _SW_SQL.format(view="v_software_sales", explore=EXPLORE))
cte("sw_by_sap", _SW_SQL.format(view="v_software_by_sap_id", explore=RARE_EXPLORE))


@query("software_yearly", SW_SHAPE, "SELECT * FROM sw")
def software_yearly(t):
    return M.software_measures(t.view("v_software_sales"), EXPLORE, EXPLOIT)


@query(
    "software_flags",
    "customer_id:long year:long has_exploration:long has_exploitation:long",
    """SELECT o_custkey AS customer_id, year(l_shipdate) AS year,
              max(CASE WHEN p_type IN ('PROMO', 'ECONOMY') AND regexp_matches(p_name, '(?i)small|green') THEN 1 ELSE 0 END) AS has_exploration,
              max(CASE WHEN p_type IN ('PROMO', 'ECONOMY') AND regexp_matches(p_name, '(?i)ring|nut') THEN 1 ELSE 0 END) AS has_exploitation
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def software_flags(t):
    sales = (
        t.table("lineitem")
        .join(t.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return M.software_flags(
        sales, "o_custkey", "l_shipdate", "p_type", "p_name", ["PROMO", "ECONOMY"], "small|green", "ring|nut"
    )


# --------------------------------------------------------------------------
# Activities
# --------------------------------------------------------------------------


@query(
    "interaction_counts",
    "customer_id:long year:long n_opportunities:long n_quotes:long n_meetings:long n_mails:long n_other:long",
    """WITH a AS (
         SELECT to_customer_id AS id, year(to_start_date) AS year, 'o' AS s FROM v_opportunities
         UNION ALL SELECT to_customer_id, year(to_close_date), 'q' FROM v_opportunities
         UNION ALL SELECT account_id, meeting_starting_year, 'm' FROM v_meetings
         UNION ALL SELECT account_id, sent_year, 'e' FROM v_mail_log
         UNION ALL SELECT account_id, activity_year, 'x' FROM v_activities
       ), n AS (SELECT id AS customer_id, year, count(*) FILTER (s = 'o') AS n_opportunities, count(*) FILTER (s = 'q') AS n_quotes,
                count(*) FILTER (s = 'm') AS n_meetings, count(*) FILTER (s = 'e') AS n_mails, count(*) FILTER (s = 'x') AS n_other
         FROM a GROUP BY 1, 2)
       SELECT g.customer_id, g.year, coalesce(n_opportunities, 0) AS n_opportunities, coalesce(n_quotes, 0) AS n_quotes,
              coalesce(n_meetings, 0) AS n_meetings, coalesce(n_mails, 0) AS n_mails, coalesce(n_other, 0) AS n_other
       FROM grid g LEFT JOIN n USING (customer_id, year)""",
)
def interaction_counts(t):
    opportunities = t.view("v_opportunities")
    counts = M.interaction_counts(
        {
            "opportunities": (opportunities, "to_customer_id", panels.yearly("to_start_date")),
            "quotes": (opportunities, "to_customer_id", panels.yearly("to_close_date")),
            "meetings": (t.view("v_meetings"), "account_id", F.col("meeting_starting_year")),
            "mails": (t.view("v_mail_log"), "account_id", F.col("sent_year")),
            "other": (t.view("v_activities"), "account_id", F.col("activity_year")),
        }
    )
    panel = P.attach_measures(grid(t), counts)
    return P.zero_missing(panel, [c for c in counts.columns if c.startswith("n_")])


cte(
    "meet",
    """SELECT account_id AS customer_id, meeting_starting_year AS year,
              count(*) FILTER (status = 'Completed') AS completed_meetings_num_total,
              coalesce(sum(meeting_duration_minutes), 0) AS total_meeting_duration
       FROM v_meetings WHERE account_id IS NOT NULL AND meeting_starting_year IS NOT NULL GROUP BY 1, 2""",
)
cte(
    "mail",
    """SELECT account_id AS customer_id, sent_year AS year, count(*) AS mails_total,
              count(*) FILTER (priority IN ('Urgent', 'High')) AS mails_high_priority,
              count(*) FILTER (priority IN ('Normal', 'Medium')) AS mails_normal_priority,
              count(*) FILTER (priority IN ('Low')) AS mails_low_priority
       FROM v_mail_log WHERE account_id IS NOT NULL AND sent_year IS NOT NULL GROUP BY 1, 2""",
)
cte(
    "other_by_name",
    """SELECT account, activity_year AS year, count(*) AS other_act_total,
              count(*) FILTER (contains(acitivy_type, 'Phone Call')) AS other_act_phone_calls,
              count(*) FILTER (contains(acitivy_type, 'Letter')) AS other_act_letters,
              count(*) FILTER (contains(acitivy_type, 'Fax')) AS other_act_faxes
       FROM v_other_activities WHERE activity_year IS NOT NULL GROUP BY 1, 2""",
)


@query(
    "meeting_yearly",
    "customer_id:long year:long completed_meetings_num_total:long total_meeting_duration:money",
    "SELECT * FROM meet",
)
def meeting_yearly(t):
    return M.meeting_measures(t.view("v_meetings"))


@query(
    "meeting_daily",
    "account_id:long day:date completed_meetings_num_total:long total_meeting_duration:money",
    """SELECT account_id, day, count(*) FILTER (status = 'Completed') AS completed_meetings_num_total,
              coalesce(sum(meeting_duration_minutes), 0) AS total_meeting_duration
       FROM v_meetings GROUP BY 1, 2""",
)
def meeting_daily(t):
    meetings = t.view("v_meetings").drop("meeting_starting_year").withColumnRenamed("day", "meeting_starting_year")
    return M.meeting_measures(meetings, DAILY)


@query(
    "mail_yearly",
    "customer_id:long year:long mails_total:long mails_high_priority:long mails_normal_priority:long mails_low_priority:long",
    "SELECT * FROM mail",
)
def mail_yearly(t):
    return M.mail_measures(t.view("v_mail_log"))


@query(
    "other_activity_yearly",
    "customer_id:text year:long other_act_total:long other_act_phone_calls:long other_act_letters:long other_act_faxes:long",
    "SELECT account AS customer_id, * EXCLUDE (account) FROM other_by_name",
)
def other_activity_yearly(t):
    return M.other_activity_measures(t.view("v_other_activities"))


ACTIVITY_SHAPE = (
    "customer_id:long year:long sales_act_synchronous:ratio sales_act_asynchronous:ratio aggregated_sales_act:ratio"
    " effort_to_revenue_ratio:ratio lagged_effort_to_revenue_ratio:ratio"
)
_MASK = "CASE WHEN relationship_status = 'active' THEN coalesce({c}, 0) END AS {c}"


def _masked(columns: str) -> str:
    return ", ".join(_MASK.format(c=c) for c in columns.split())


cte(
    "act_panel",
    f"""SELECT customer_id, year, relationship_status, {_masked(
        "to_sum_val_opps_won completed_meetings_num_total total_meeting_duration mails_total mails_high_priority"
        " mails_normal_priority mails_low_priority other_act_total other_act_phone_calls other_act_letters other_act_faxes")}
       FROM (SELECT g.customer_id, g.year, g.relationship_status, o.to_sum_val_opps_won, m.*, e.*, x.*
             FROM grid g LEFT JOIN v_customers c ON g.customer_id = c.customer_id
             LEFT JOIN opp o ON o.customer_id = g.customer_id AND o.year = g.year
             LEFT JOIN (SELECT customer_id AS mc, year AS my, * EXCLUDE (customer_id, year) FROM meet) m ON m.mc = g.customer_id AND m.my = g.year
             LEFT JOIN (SELECT customer_id AS ec, year AS ey, * EXCLUDE (customer_id, year) FROM mail) e ON e.ec = g.customer_id AND e.ey = g.year
             LEFT JOIN (SELECT account AS xa, year AS xy, * EXCLUDE (account, year) FROM other_by_name) x ON x.xa = c.customer_name AND x.xy = g.year)""",
)
cte(
    "act_totals",
    """SELECT *, 1000 * aggregated_sales_act / CASE WHEN to_sum_val_opps_won > 0 THEN to_sum_val_opps_won
                     WHEN to_sum_val_opps_won IS NOT NULL THEN 1 END AS effort_to_revenue_ratio,
              1000 * lag(aggregated_sales_act) OVER (PARTITION BY customer_id ORDER BY year)
                   / CASE WHEN to_sum_val_opps_won > 0 THEN to_sum_val_opps_won
                     WHEN to_sum_val_opps_won IS NOT NULL THEN 1 END AS lagged_effort_to_revenue_ratio
       FROM (SELECT *, sales_act_synchronous + sales_act_asynchronous AS aggregated_sales_act
             FROM (SELECT *, coalesce(completed_meetings_num_total, 0) + coalesce(other_act_phone_calls, 0) AS sales_act_synchronous,
                          coalesce(mails_total, 0) + coalesce(other_act_letters, 0) + coalesce(other_act_faxes, 0) AS sales_act_asynchronous
                   FROM act_panel))""",
)


def activity_panel(t: Tables) -> DataFrame:
    attributes = P.attributes_from(t.view("v_customers"), "customer_id", ["customer_id"])
    others = P.rekey_measures(M.other_activity_measures(t.view("v_other_activities")), attributes, "customer_name")
    tables = [
        opportunity_table(t).select("customer_id", "year", "to_sum_val_opps_won"),
        M.meeting_measures(t.view("v_meetings")),
        M.mail_measures(t.view("v_mail_log")),
        others,
    ]
    panel = P.align_measures(grid(t), tables)
    return P.mask_inactive(panel, ["to_sum_val_opps_won", *M.ACTIVITY_COLUMNS])


@query("activity_totals", ACTIVITY_SHAPE, "SELECT * FROM act_totals")
def activity_totals(t):
    return M.activity_totals(activity_panel(t))


@query(
    "lag_effort",
    "customer_id:long year:long aggregated_sales_act:ratio previous_sales_act:ratio",
    """SELECT *, lag(aggregated_sales_act, 1) OVER (PARTITION BY customer_id ORDER BY year) AS previous_sales_act
       FROM act_totals""",
)
def lag_effort(t):
    return G.lag_value(M.activity_totals(activity_panel(t)), "aggregated_sales_act", "previous_sales_act")


# --------------------------------------------------------------------------
# Service
# --------------------------------------------------------------------------

CASE_COLUMNS = (
    "n_cases n_breakdowns n_complaints n_failures n_low_priority n_default_priority n_high_priority"
    " n_delayed_callbacks Low_service_dissatisfiers_sum Default_service_dissatisfiers_sum"
    " High_service_dissatisfiers_sum all_dissatisfaction"
)
CASE_SHAPE = (
    "customer_id:{key} year:long avg_reaction_time:ratio " + " ".join(f"{c}:long" for c in CASE_COLUMNS.split())
)
_CASE_SQL = """SELECT sc_customer_number AS customer_id, case_year AS year, count(*) AS n_cases,
              count(*) FILTER (sc_case_type = 'Breakdown') AS n_breakdowns, count(*) FILTER (sc_case_type = 'Complaint') AS n_complaints,
              count(*) FILTER (sc_case_type = 'Failure') AS n_failures, count(*) FILTER (sc_priority = 'Low') AS n_low_priority,
              count(*) FILTER (sc_priority = 'Default') AS n_default_priority, count(*) FILTER (sc_priority = 'High') AS n_high_priority,
              avg(sc_reaction_time) AS avg_reaction_time, count(*) FILTER (sc_delayed_callbacks > 0) AS n_delayed_callbacks,
              count(*) FILTER (sc_case_type <> 'Inquiry' AND sc_priority = 'Low') AS Low_service_dissatisfiers_sum,
              count(*) FILTER (sc_case_type <> 'Inquiry' AND sc_priority = 'Default') AS Default_service_dissatisfiers_sum,
              count(*) FILTER (sc_case_type <> 'Inquiry' AND sc_priority = 'High') AS High_service_dissatisfiers_sum,
              count(*) FILTER (sc_case_type <> 'Inquiry') AS all_dissatisfaction
       FROM {view} WHERE case_year IS NOT NULL GROUP BY 1, 2"""
cte("cases_y", _CASE_SQL.format(view="v_cases"))
cte("cases_by_sap", _CASE_SQL.format(view="v_cases_by_sap_id"))
cte(
    "missions_y",
    """SELECT mission_id AS customer_id, mission_year AS year, count(*) AS n_missions, avg(waiting_time_days) AS avg_waiting_time,
              avg(working_time_h) AS avg_working_time, count(*) FILTER (missions_delayed = 'Mission delayed') AS n_delayed_missions
       FROM v_missions GROUP BY 1, 2""",
)


@query("case_yearly", CASE_SHAPE.format(key="long"), "SELECT * FROM cases_y")
def case_yearly(t):
    return M.case_measures(t.view("v_cases"))


@query(
    "mission_yearly",
    "customer_id:long year:long n_missions:long avg_waiting_time:ratio avg_working_time:ratio n_delayed_missions:long",
    "SELECT * FROM missions_y",
)
def mission_yearly(t):
    return M.mission_measures(t.view("v_missions"))


cte(
    "service_panel",
    f"""SELECT customer_id, year, relationship_status, {_masked(CASE_COLUMNS + " avg_reaction_time")}
        FROM grid LEFT JOIN cases_y USING (customer_id, year)""",
)


def service_panel(t: Tables) -> DataFrame:
    columns = CASE_COLUMNS.split() + ["avg_reaction_time"]
    return P.mask_inactive(P.align_measures(grid(t), [M.case_measures(t.view("v_cases"))]), columns)


@query(
    "service_ratios",
    "customer_id:long year:long n_cases:long service_case_intensity:ratio service_problem_intensity:ratio",
    """SELECT *, CAST(n_cases AS DOUBLE) AS service_case_intensity,
              (n_breakdowns + n_complaints + n_failures) / CAST(CASE WHEN n_cases > 0 THEN n_cases ELSE 1 END AS DOUBLE)
                AS service_problem_intensity
       FROM service_panel""",
)
def service_ratios(t):
    return M.service_ratios(service_panel(t))


@query(
    "service_counts",
    "customer_id:long year:long n_cases:long n_missions:long",
    """SELECT customer_id, year, coalesce(n_cases, 0) AS n_cases, coalesce(n_missions, 0) AS n_missions
       FROM grid LEFT JOIN cases_y USING (customer_id, year) LEFT JOIN missions_y USING (customer_id, year)""",
)
def service_counts(t):
    counts = M.service_counts(
        {
            "cases": (t.view("v_cases"), "sc_customer_number", F.col("case_year")),
            "missions": (t.view("v_missions"), "mission_id", F.col("mission_year")),
        }
    )
    return P.zero_missing(P.attach_measures(grid(t), counts), ["n_cases", "n_missions"])


# --------------------------------------------------------------------------
# Installed base and registered products
# --------------------------------------------------------------------------

cte(
    "installed_y",
    """SELECT *, sum(installed_hw_power_bi) OVER (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING) AS installed_hw_cum
       FROM (SELECT customer_id, construction_year AS year, count(*) AS installed_hw_power_bi,
                    count(DISTINCT equipment_type) AS n_equipment_types, count(DISTINCT equipment_group) AS n_equipment_groups
             FROM v_installed_base WHERE construction_year IS NOT NULL GROUP BY 1, 2)""",
)
cte(
    "products_y",
    """SELECT customer_id, completion_year AS year, count(*) AS reg_prods_total,
              count(*) FILTER (contains(category, 'ERP Registered Product')) AS ERP_Registered_Product,
              count(*) FILTER (contains(category, 'Manual Registered Product')) AS Manual_Registered_Product,
              count(*) FILTER (contains(category, 'Registered Competitor Product')) AS Registered_Competitor_Product
       FROM v_registered_products GROUP BY 1, 2""",
)


@query(
    "installed_base_yearly",
    "customer_id:long year:long installed_hw_power_bi:long n_equipment_types:long n_equipment_groups:long installed_hw_cum:long",
    "SELECT * FROM installed_y",
)
def installed_base_yearly(t):
    return M.installed_base_measures(t.view("v_installed_base"))


@query(
    "machine_counts_cum",
    "customer_id:long year:long n_machines_installed:long cumulative_machines:long",
    """SELECT *, sum(n_machines_installed) OVER (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING) AS cumulative_machines
       FROM (SELECT g.customer_id, g.year, coalesce(n, 0) AS n_machines_installed
             FROM grid g LEFT JOIN (SELECT customer_id, year(delivery_date) AS year, count(DISTINCT serial_number) AS n
                                    FROM v_installed_base GROUP BY 1, 2) USING (customer_id, year))""",
)
def machine_counts_cum(t):
    counts = M.machine_counts(t.view("v_installed_base"), "customer_id", "delivery_date")
    return panels.build_simple_panel(
        firsts(t), None, [counts], LO, HI, running={"n_machines_installed": "cumulative_machines"}
    )


@query(
    "registered_products_yearly",
    "customer_id:long year:long reg_prods_total:long ERP_Registered_Product:long Manual_Registered_Product:long"
    " Registered_Competitor_Product:long",
    "SELECT * FROM products_y",
)
def registered_products_yearly(t):
    return M.registered_product_measures(t.view("v_registered_products"))


@query(
    "registered_products_capped",
    "customer_id:long year:long reg_prods_total:long",
    "SELECT customer_id, year, reg_prods_total FROM products_y WHERE year <= 2000",
)
def registered_products_capped(t):
    return M.registered_product_measures(t.view("v_registered_products"), cap=2000).select("customer_id", "year", "reg_prods_total")


cte(
    "product_panel",
    f"""SELECT *,
          sum(coalesce(reg_prods_total, 0)) OVER w AS reg_prods_total_cum,
          sum(coalesce(ERP_Registered_Product, 0)) OVER w AS erp_registered_product_cum,
          sum(coalesce(Manual_Registered_Product, 0)) OVER w AS Manual_Registered_Product_cum,
          sum(coalesce(Registered_Competitor_Product, 0)) OVER w AS Registered_Competitor_Product_cum
        FROM (SELECT customer_id, year, relationship_status,
                {_masked("reg_prods_total ERP_Registered_Product Manual_Registered_Product Registered_Competitor_Product")}
              FROM grid LEFT JOIN products_y USING (customer_id, year))
        WINDOW w AS (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING)""",
)
_SHARES = """coalesce(ERP_Registered_Product, 0) + coalesce(Manual_Registered_Product, 0) AS all_T_reg_products_in_year,
       CASE WHEN reg_prods_total > 0 THEN (coalesce(ERP_Registered_Product, 0) + coalesce(Manual_Registered_Product, 0)) / CAST(reg_prods_total AS DOUBLE)
            WHEN reg_prods_total IS NOT NULL THEN 0 END AS share_of_purchase_T_in_year,
       CASE WHEN reg_prods_total > 0 THEN coalesce(Registered_Competitor_Product, 0) / CAST(reg_prods_total AS DOUBLE)
            WHEN reg_prods_total IS NOT NULL THEN 0 END AS share_of_purchase_competitor_in_year,
       CASE WHEN reg_prods_total_cum > 0 THEN (erp_registered_product_cum + Manual_Registered_Product_cum) / CAST(reg_prods_total_cum AS DOUBLE)
            ELSE 0 END AS share_of_purchase_T_cum,
       CASE WHEN reg_prods_total_cum > 0 THEN Registered_Competitor_Product_cum / CAST(reg_prods_total_cum AS DOUBLE)
            ELSE 0 END AS share_of_purchase_competitor_cum"""


@query(
    "share_of_purchase",
    "customer_id:long year:long all_T_reg_products_in_year:long share_of_purchase_T_in_year:ratio"
    " share_of_purchase_competitor_in_year:ratio share_of_purchase_T_cum:ratio share_of_purchase_competitor_cum:ratio"
    " reg_prods_total_ra_5:ratio",
    f"""SELECT *, {_SHARES},
          CASE WHEN count(reg_prods_total) OVER (PARTITION BY customer_id ORDER BY year ROWS 4 PRECEDING) = 5
               THEN avg(reg_prods_total) OVER (PARTITION BY customer_id ORDER BY year ROWS 4 PRECEDING) END AS reg_prods_total_ra_5
        FROM product_panel""",
)
def share_of_purchase(t):
    table = M.registered_product_measures(t.view("v_registered_products"))
    panel = P.mask_inactive(P.align_measures(grid(t), [table]), panels.PRODUCT_COLUMNS)
    return panels.product_features(panel, PanelKeys())


# --------------------------------------------------------------------------
# Attaching and masking
# --------------------------------------------------------------------------


@query(
    "attach_measures",
    "customer_id:long year:long customer_sap_id:text ts_sales_sw_num_total:long ts_sales_total_sw:money",
    """SELECT g.customer_id, g.year, c.customer_sap_id, s.ts_sales_sw_num_total, s.ts_sales_total_sw
       FROM grid g LEFT JOIN v_customers c USING (customer_id)
       LEFT JOIN sw_by_sap s ON s.customer_id = c.customer_sap_id AND s.year = g.year""",
)
def attach_measures(t):
    ids = t.view("v_customers").select("customer_id", "customer_sap_id")
    panel = P.base_panel(P.add_attributes(firsts(t), ids), LO, HI)
    table = M.software_measures(t.view("v_software_by_sap_id"), RARE_EXPLORE, EXPLOIT)
    return P.attach_measures(panel, table, on="customer_sap_id")


OPP_COLUMNS = "to_number_of_opps to_sum_opps_won to_sum_val_opps_won to_value_software"
cte(
    "opp_panel",
    f"SELECT customer_id, year, first_interaction, relationship_status, {_masked(OPP_COLUMNS)} FROM grid LEFT JOIN opp USING (customer_id, year)",
)


def opp_panel(t: Tables) -> DataFrame:
    table = opportunity_table(t).select("customer_id", "year", *OPP_COLUMNS.split())
    return P.mask_inactive(P.align_measures(grid(t), [table]), OPP_COLUMNS.split())


@query(
    "mask_inactive",
    "customer_id:long year:long relationship_status:text to_number_of_opps:long to_sum_val_opps_won:money",
    "SELECT * FROM opp_panel",
)
def mask_inactive(t):
    table = opportunity_table(t).select("customer_id", "year", *OPP_COLUMNS.split())
    return P.mask_inactive(P.attach_measures(grid(t), table), OPP_COLUMNS.split())


# --------------------------------------------------------------------------
# Window features
# --------------------------------------------------------------------------

_W = "WINDOW w AS (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING)"


@query(
    "cumulative_measures",
    "customer_id:long year:long to_cum_opps:long to_cum_opps_won:long to_cum_val_opps_won:money",
    f"""SELECT customer_id, year, sum(coalesce(to_number_of_opps, 0)) OVER w AS to_cum_opps,
               sum(coalesce(to_sum_opps_won, 0)) OVER w AS to_cum_opps_won,
               sum(coalesce(to_sum_val_opps_won, 0)) OVER w AS to_cum_val_opps_won
        FROM opp_panel {_W}""",
)
def cumulative_measures(t):
    columns = {
        "to_number_of_opps": "to_cum_opps",
        "to_sum_opps_won": "to_cum_opps_won",
        "to_sum_val_opps_won": "to_cum_val_opps_won",
    }
    return G.cumulative(opp_panel(t), columns)


def _rolling_sql(k: int) -> str:
    frame = f"OVER (PARTITION BY customer_id ORDER BY year ROWS {k - 1} PRECEDING)"
    return f"""SELECT customer_id, year,
          CASE WHEN count(to_number_of_opps) {frame} = {k} THEN avg(to_number_of_opps) {frame} END AS rolling_opps,
          CASE WHEN count(*) {frame} = {k} THEN avg(coalesce(to_sum_val_opps_won, 0)) {frame} END AS rolling_value
        FROM opp_panel"""


def _rolling(t: Tables, k: int) -> DataFrame:
    panel = G.rolling_mean(opp_panel(t), {"to_number_of_opps": "rolling_opps"}, k)
    return G.rolling_mean(panel, {"to_sum_val_opps_won": "rolling_value"}, k, null_as_zero=True)


@query("rolling_mean_3", "customer_id:long year:long rolling_opps:ratio rolling_value:money", _rolling_sql(3))
def rolling_mean_3(t):
    return _rolling(t, 3)


@query("rolling_mean_5", "customer_id:long year:long rolling_opps:ratio rolling_value:money", _rolling_sql(5))
def rolling_mean_5(t):
    return _rolling(t, 5)


cte(
    "first_won",
    """SELECT *, min(CASE WHEN to_sum_opps_won > 0 THEN year END) OVER (PARTITION BY customer_id) AS first_won_year,
              CASE WHEN to_sum_opps_won > 0 THEN year END AS won_year
       FROM opp_panel""",
)


def first_won(t: Tables) -> DataFrame:
    won = F.col("to_sum_opps_won") > 0
    return G.first_period_where(opp_panel(t), {"first_won_year": won}).withColumn("won_year", F.when(won, F.col("year")))


@query("first_period_where", "customer_id:long year:long first_won_year:long", "SELECT * FROM first_won")
def first_period_where(t):
    return first_won(t)


@query(
    "fill_down",
    "customer_id:long year:long won_year:long",
    """SELECT customer_id, year, last_value(won_year IGNORE NULLS)
         OVER (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING) AS won_year FROM first_won""",
)
def fill_down(t):
    return G.fill(first_won(t), ["won_year"], "down")


@query(
    "fill_downup",
    "customer_id:long year:long won_year:long",
    """SELECT customer_id, year, coalesce(
         last_value(won_year IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING),
         first_value(won_year IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY year
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS won_year FROM first_won""",
)
def fill_downup(t):
    return G.fill(first_won(t), ["won_year"], "downup")


@query(
    "years_since",
    "customer_id:long year:long years_since_first_won:long years_or_zero:long",
    """SELECT customer_id, year, year - first_won_year AS years_since_first_won,
              coalesce(year - first_won_year, 0) AS years_or_zero FROM first_won""",
)
def years_since(t):
    panel = G.periods_since(first_won(t), {"first_won_year": "years_since_first_won"})
    return G.periods_since(panel, {"first_won_year": "years_or_zero"}, default=0)


@query(
    "ever_post_flags",
    "customer_id:long year:long ever_won:bool post_won:long",
    """SELECT customer_id, year, first_won_year IS NOT NULL AS ever_won,
              CASE WHEN year >= first_won_year THEN 1 ELSE 0 END AS post_won FROM first_won""",
)
def ever_post_flags(t):
    return G.ever_and_post(first_won(t), {"first_won_year": ("ever_won", "post_won")})


# --------------------------------------------------------------------------
# Full panel: relationship, purchase and treatment features
# --------------------------------------------------------------------------

SPEC = PanelSpec(
    first_period=1996,
    last_period=2001,
    lead_in=1,
    country="NATION_3",
    exploration_pattern=RARE_EXPLORE,
    exploitation_pattern=EXPLOIT,
    test_account_pattern="Customer#0+[0-9]*13$",
    base_year=BASE_YEAR,
)


def inputs(t: Tables) -> panels.PanelInputs:
    t = t.share_lines()
    customers = t.view("v_customers")
    return panels.PanelInputs(
        opportunities=t.view("v_opportunities"),
        customers=customers,
        attributes=customers,
        attributes_entity="customer_id",
        order_by=("customer_id",),
        software_sales=t.view("v_software_by_sap_id"),
        meetings=t.view("v_meetings"),
        mails=t.view("v_mail_log"),
        other_activities=t.view("v_other_activities"),
        cases=t.view("v_cases_by_sap_id"),
        missions=t.view("v_missions"),
        installed_base=t.view("v_installed_base").withColumn(
            "customer_number", F.concat(F.lit("S"), F.col("customer_id").cast("string"))
        ),
        registered_products=t.view("v_registered_products"),
    )


def features(t: Tables) -> DataFrame:
    return panels.feature_panel(inputs(t), SPEC)


cte(
    "joined",
    f"""SELECT g.customer_id, g.year, g.first_interaction, g.relationship_status, g.customer_name, g.country, g.abc_classification,
          {_masked("to_number_of_opps to_sum_opps_won to_sum_val_opps_won to_value_software ts_sales_sw_num_total ts_sales_total_sw"
                   " ts_sales_num_sw_explore ts_sales_num_sw_exploit ts_sales_total_exploration n_cases n_breakdowns n_complaints"
                   " n_failures avg_reaction_time all_dissatisfaction High_service_dissatisfiers_sum n_missions n_delayed_missions"
                   " installed_hw_power_bi installed_hw_cum n_equipment_types reg_prods_total ERP_Registered_Product"
                   " Manual_Registered_Product Registered_Competitor_Product completed_meetings_num_total mails_total"
                   " other_act_phone_calls other_act_letters other_act_faxes")},
          f.to_first_purchase_year
        FROM (SELECT * FROM grid LEFT JOIN v_customers USING (customer_id)) g
        LEFT JOIN opp USING (customer_id, year)
        LEFT JOIN (SELECT customer_id, year, min(CASE WHEN to_sum_opps_won > 0 THEN year END) OVER (PARTITION BY customer_id) AS to_first_purchase_year
                   FROM opp) f ON f.customer_id = g.customer_id AND f.year = g.year
        LEFT JOIN sw_by_sap s ON s.customer_id = g.customer_sap_id AND s.year = g.year
        LEFT JOIN cases_by_sap k ON k.customer_id = g.customer_sap_id AND k.year = g.year
        LEFT JOIN missions_y m ON m.customer_id = g.customer_id AND m.year = g.year
        LEFT JOIN installed_y i ON concat('S', i.customer_id) = g.customer_sap_id AND i.year = g.year
        LEFT JOIN products_y p ON p.customer_id = g.customer_id AND p.year = g.year
        LEFT JOIN meet ON meet.customer_id = g.customer_id AND meet.year = g.year
        LEFT JOIN mail ON mail.customer_id = g.customer_id AND mail.year = g.year
        LEFT JOIN other_by_name x ON x.account = g.customer_name AND x.year = g.year""",
)
cte(
    "windowed",
    """SELECT *,
          sum(coalesce(to_number_of_opps, 0)) OVER w AS to_cum_opps,
          sum(coalesce(to_sum_opps_won, 0)) OVER w AS to_cum_opps_won,
          sum(coalesce(to_sum_val_opps_won, 0)) OVER w AS to_cum_val_opps_won,
          CASE WHEN count(*) OVER r3 = 3 THEN avg(coalesce(to_number_of_opps, 0)) OVER r3 END AS to_rolling_opps_3yr,
          CASE WHEN count(all_dissatisfaction) OVER r5 = 5 THEN avg(all_dissatisfaction) OVER r5 END AS all_dissatisfaction_ra_5,
          sum(coalesce(ts_sales_total_sw, 0)) OVER w AS ts_sales_total_sw_cum,
          min(CASE WHEN to_number_of_opps > 0 THEN year END) OVER e AS first_opp_year,
          min(CASE WHEN ts_sales_num_sw_explore > 0 THEN year END) OVER e AS ts_first_explore_year,
          min(CASE WHEN ts_sales_num_sw_exploit > 0 THEN year END) OVER e AS ts_first_exploit_year,
          sum(coalesce(reg_prods_total, 0)) OVER w AS reg_prods_total_cum,
          sum(coalesce(ERP_Registered_Product, 0)) OVER w AS erp_registered_product_cum,
          sum(coalesce(Manual_Registered_Product, 0)) OVER w AS Manual_Registered_Product_cum,
          min(CASE WHEN relationship_status = 'active' THEN year END) OVER e AS first_purchase_year,
          last_value(CASE WHEN to_sum_opps_won > 0 THEN year END IGNORE NULLS) OVER w AS lt_purchase_at_T_date,
          coalesce(completed_meetings_num_total, 0) + coalesce(other_act_phone_calls, 0) AS sales_act_synchronous,
          coalesce(mails_total, 0) + coalesce(other_act_letters, 0) + coalesce(other_act_faxes, 0) AS sales_act_asynchronous
       FROM joined
       WINDOW w AS (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING),
              r3 AS (PARTITION BY customer_id ORDER BY year ROWS 2 PRECEDING),
              r5 AS (PARTITION BY customer_id ORDER BY year ROWS 4 PRECEDING),
              e AS (PARTITION BY customer_id)""",
)
cte(
    "dated",
    """SELECT *,
          coalesce(
            CASE WHEN lag(to_cum_opps_won, 1, 0) OVER o = 0 AND to_cum_opps_won > 0 THEN year END,
            CASE WHEN lag(erp_registered_product_cum, 1, 0) OVER o = 0 AND erp_registered_product_cum > 0 THEN year END,
            CASE WHEN lag(Manual_Registered_Product_cum, 1, 0) OVER o = 0 AND Manual_Registered_Product_cum > 0 THEN year END) AS ft_start,
          lag(lt_purchase_at_T_date) OVER o AS prev_purchase,
          CASE WHEN relationship_status = 'active' THEN year - first_purchase_year + 1 ELSE 0 END AS customer_tenure,
          CASE WHEN relationship_status = 'pre_relationship' AND first_purchase_year IS NOT NULL THEN first_purchase_year - year ELSE 0 END AS prospect_tenure,
          year - first_purchase_year AS years_since_first_purchase,
          CASE WHEN year >= ts_first_explore_year THEN 1 ELSE 0 END AS treatment,
          CASE WHEN ts_first_explore_year IS NOT NULL THEN 1 ELSE 0 END AS ever_treated,
          year - coalesce(ts_first_explore_year, 1998) AS time_to_treat
       FROM windowed WINDOW o AS (PARTITION BY customer_id ORDER BY year)""",
)
cte(
    "featured",
    """SELECT *, last_value(ft_start IGNORE NULLS) OVER w AS ft_purchase_at_t_date,
          year - prev_purchase AS duration_since_last_purchase,
          coalesce(year - last_value(ft_start IGNORE NULLS) OVER w, 0) AS customer_duration_ft_purchase,
          coalesce(year - ts_first_explore_year, 0) AS explore_duration_ft_purchase,
          coalesce(year - ts_first_exploit_year, 0) AS exploit_duration_ft_purchase,
          CASE WHEN time_to_treat >= 0 THEN 1 ELSE 0 END AS post_period,
          CASE WHEN time_to_treat <= -3 THEN 1 ELSE 0 END AS pre_treatment_3plus,
          CASE WHEN time_to_treat = -2 THEN 1 ELSE 0 END AS pre_treatment_2,
          CASE WHEN time_to_treat = -1 THEN 1 ELSE 0 END AS pre_treatment_1,
          CASE WHEN time_to_treat = 0 THEN 1 ELSE 0 END AS post_treatment_0,
          CASE WHEN time_to_treat = 1 THEN 1 ELSE 0 END AS post_treatment_1,
          CASE WHEN time_to_treat = 2 THEN 1 ELSE 0 END AS post_treatment_2,
          CASE WHEN time_to_treat >= 3 THEN 1 ELSE 0 END AS post_treatment_3plus,
          max(CASE WHEN time_to_treat = 0 THEN customer_tenure END) OVER (PARTITION BY customer_id) AS customer_relationship_length_at_treatment
       FROM dated WINDOW w AS (PARTITION BY customer_id ORDER BY year ROWS UNBOUNDED PRECEDING)""",
)
cte(
    "suspicious",
    """SELECT DISTINCT customer_id FROM featured
       WHERE (to_sum_val_opps_won > 0 AND to_sum_val_opps_won <= 10)
          OR (country = 'NATION_3' AND to_sum_val_opps_won > 10000000)
          OR regexp_matches(customer_name, '(?i)Customer#0+[0-9]*13$')
          OR (first_purchase_year IS NULL AND relationship_status <> 'pre_relationship')""",
)
cte(
    "final_panel",
    """SELECT * FROM featured
       WHERE NOT EXISTS (SELECT 1 FROM suspicious s WHERE s.customer_id IS NOT DISTINCT FROM featured.customer_id)
         AND year BETWEEN 1996 AND 2001 AND (country IS NULL OR country = 'NATION_3') AND first_purchase_year IS NOT NULL""",
)


@query(
    "tenure_features",
    "customer_id:long year:long first_purchase_year:long customer_tenure:long prospect_tenure:long years_since_first_purchase:long",
    "SELECT * FROM featured",
)
def tenure_features(t):
    return H.tenure_features(grid(t))


def _purchase_panel(t: Tables) -> DataFrame:
    products = M.registered_product_measures(t.view("v_registered_products"))
    opps = opportunity_table(t).select("customer_id", "year", *OPP_COLUMNS.split())
    panel = P.align_measures(grid(t), [opps, products])
    panel = P.mask_inactive(panel, [*OPP_COLUMNS.split(), *panels.PRODUCT_COLUMNS])
    return G.cumulative(
        panel,
        {
            "to_sum_opps_won": "to_cum_opps_won",
            "ERP_Registered_Product": "erp_registered_product_cum",
            "Manual_Registered_Product": "Manual_Registered_Product_cum",
        },
    )


@query("first_purchase_transition", "customer_id:long year:long ft_purchase_at_t_date:long", "SELECT * FROM featured")
def first_purchase_transition(t):
    return H.first_purchase_date(_purchase_panel(t))


@query(
    "recency",
    "customer_id:long year:long lt_purchase_at_T_date:long duration_since_last_purchase:long customer_duration_ft_purchase:long",
    "SELECT * FROM featured",
)
def recency(t):
    return H.recency(H.first_purchase_date(_purchase_panel(t)))


def treated(t: Tables) -> DataFrame:
    sales = M.software_measures(t.view("v_software_by_sap_id"), RARE_EXPLORE, EXPLOIT)
    table = P.rekey_measures(sales, t.view("v_customers"), "customer_sap_id")
    panel = P.mask_inactive(P.align_measures(grid(t), [table]), panels.SOFTWARE_COLUMNS)
    panel = H.tenure_features(panels.software_features(panel, PanelKeys()))
    return H.treatment_features(panel, base_year=BASE_YEAR)


@query(
    "treatment_features",
    "customer_id:long year:long treatment:long ever_treated:long time_to_treat:long post_period:long pre_treatment_3plus:long"
    " pre_treatment_2:long pre_treatment_1:long post_treatment_0:long post_treatment_1:long post_treatment_2:long post_treatment_3plus:long",
    "SELECT * FROM featured",
)
def treatment_features(t):
    return treated(t)


@query(
    "tenure_at_treatment",
    "customer_id:long year:long customer_relationship_length_at_treatment:long",
    "SELECT * FROM featured",
)
def tenure_at_treatment(t):
    return H.value_at_event(treated(t), "customer_tenure", "customer_relationship_length_at_treatment")


def _judged(t: Tables) -> DataFrame:
    attributes = P.attributes_from(t.view("v_customers"), "customer_id", ["customer_id"])
    panel = P.base_panel(P.add_attributes(firsts(t), attributes), LO, HI)
    opps = opportunity_table(t).select("customer_id", "year", *OPP_COLUMNS.split())
    return H.tenure_features(P.mask_inactive(P.align_measures(panel, [opps]), OPP_COLUMNS.split()))


@query("suspicious_entities", "customer_id:long", "SELECT * FROM suspicious")
def suspicious_entities(t):
    return H.suspicious_entities(_judged(t), SPEC.country, test_accounts=SPEC.test_account_pattern)


@query(
    "finalise_panel",
    "customer_id:long year:long country:text relationship_status:text to_number_of_opps:long to_sum_val_opps_won:money"
    " first_purchase_year:long customer_tenure:long",
    "SELECT * FROM final_panel",
)
def finalise_panel(t):
    return H.finalise_panel(
        _judged(t), SPEC.first_period, SPEC.last_period, SPEC.country, test_accounts=SPEC.test_account_pattern
    )


FLAGSHIP_SHAPE = (
    "customer_id:long year:long relationship_status:text customer_name:text country:text abc_classification:text"
    " first_interaction:long to_number_of_opps:long to_sum_opps_won:long to_sum_val_opps_won:money to_value_software:money"
    " to_first_purchase_year:long to_cum_opps:long to_cum_opps_won:long to_cum_val_opps_won:money first_opp_year:long"
    " ts_sales_sw_num_total:long ts_sales_total_sw:money ts_sales_total_sw_cum:money ts_first_explore_year:long"
    " ts_first_exploit_year:long completed_meetings_num_total:long mails_total:long sales_act_synchronous:long"
    " sales_act_asynchronous:long n_cases:long n_missions:long n_delayed_missions:long avg_reaction_time:ratio"
    " all_dissatisfaction:long installed_hw_power_bi:long installed_hw_cum:long n_equipment_types:long reg_prods_total:long"
    " reg_prods_total_cum:long first_purchase_year:long customer_tenure:long prospect_tenure:long ft_purchase_at_t_date:long"
    " lt_purchase_at_T_date:long duration_since_last_purchase:long customer_duration_ft_purchase:long"
    " explore_duration_ft_purchase:long exploit_duration_ft_purchase:long treatment:long ever_treated:long time_to_treat:long"
    " post_period:long customer_relationship_length_at_treatment:long"
)


@query("flagship_panel", FLAGSHIP_SHAPE, "SELECT * FROM final_panel")
def flagship_panel(t):
    return panels.build_panel(inputs(t), SPEC)


@query(
    "simple_panel",
    "customer_id:long year:long relationship_status:text main_sector:text n_opportunities:long n_cases:long n_missions:long"
    " n_machines_installed:long cumulative_machines:long n_reg_products:long",
    """SELECT g.*, c.main_sector, coalesce(a.n, 0) AS n_opportunities, coalesce(k.n_cases, 0) AS n_cases,
              coalesce(m.n_missions, 0) AS n_missions, coalesce(i.n, 0) AS n_machines_installed,
              sum(coalesce(i.n, 0)) OVER (PARTITION BY g.customer_id ORDER BY g.year ROWS UNBOUNDED PRECEDING) AS cumulative_machines,
              coalesce(r.n, 0) AS n_reg_products
       FROM grid g LEFT JOIN v_customers c ON c.customer_id = g.customer_id
       LEFT JOIN (SELECT to_customer_id AS id, year(to_start_date) AS y, count(*) AS n FROM v_opportunities GROUP BY 1, 2) a ON a.id = g.customer_id AND a.y = g.year
       LEFT JOIN cases_y k ON k.customer_id = g.customer_id AND k.year = g.year
       LEFT JOIN missions_y m ON m.customer_id = g.customer_id AND m.year = g.year
       LEFT JOIN (SELECT customer_id AS id, year(delivery_date) AS y, count(DISTINCT serial_number) AS n FROM v_installed_base GROUP BY 1, 2) i ON i.id = g.customer_id AND i.y = g.year
       LEFT JOIN (SELECT customer_id AS id, completion_year AS y, count(*) AS n FROM v_registered_products GROUP BY 1, 2) r ON r.id = g.customer_id AND r.y = g.year""",
)
def simple_panel(t):
    counts = M.count_by_source(
        {
            "opportunities": (t.view("v_opportunities"), "to_customer_id", panels.yearly("to_start_date")),
            "cases": (t.view("v_cases"), "sc_customer_number", F.col("case_year")),
            "missions": (t.view("v_missions"), "mission_id", F.col("mission_year")),
            "reg_products": (t.view("v_registered_products"), "customer_id", F.col("completion_year")),
        }
    )
    machines = M.machine_counts(t.view("v_installed_base"), "customer_id", "delivery_date")
    attributes = P.attributes_from(t.view("v_customers"), "customer_id", ["customer_id"])
    return panels.build_simple_panel(
        firsts(t), attributes, [counts, machines], LO, HI, running={"n_machines_installed": "cumulative_machines"}
    )
