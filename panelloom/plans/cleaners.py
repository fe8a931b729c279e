"""One declarative ``CleanSpec`` per dataset and the single function that runs them.

The order of steps is the same for every dataset: drop empty columns, standardise and
rename columns, tidy text, type the columns, derive features, de-duplicate, unify ids.
Dropping empty columns and planning the conversion are one aggregation each, so ``df``
should be a stored layer rather than a chain of parsing steps.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from panelloom.functions.parsing import percent_points
from panelloom.operators import cleaning as E
from panelloom.operators import convert as V
from panelloom.operators import schema as S
from panelloom.operators.quality import flag_date_inconsistency, row_completeness
from panelloom.sources.extracts import CORRUPT, POSITION, fitting

Step = Callable[[DataFrame], DataFrame]
Naming = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class CleanSpec:
    """How one dataset is cleaned. Type lists are patterns of (renamed) column names."""

    naming: Naming | None = S.clean_names
    rename: Mapping[str, str] = field(default_factory=dict)
    questions: Mapping[str, str] = field(default_factory=dict)
    squish: bool = True
    numeric: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    mixed_dates: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    serial_timestamps: tuple[str, ...] = ()
    percent: tuple[str, ...] = ()
    logical: tuple[str, ...] = ()
    category: tuple[str, ...] = ()
    weeks: Mapping[str, str] = field(default_factory=dict)
    derive: tuple[Step, ...] = ()
    dedupe: tuple[tuple[str, ...], ...] = ()
    ids: str = ""


def _named(df: DataFrame, patterns: Sequence[str], taken: Sequence[str] = ()) -> tuple[str, ...]:
    return tuple(c for c in df.columns if c not in taken and any(re.search(p, c) for p in patterns))


def _on_body(df: DataFrame, step: Step) -> DataFrame:
    """Apply a naming step to all but the row-position columns."""
    position = [c for c in (*POSITION, CORRUPT) if c in df.columns]
    names = [f"`{c}`" for c in df.columns if c not in position]
    return df.select(*position, *names).toDF(*position, *step(df.select(*names)).columns)


def clean(df: DataFrame | None, spec: CleanSpec, order_by: Sequence[str] = POSITION) -> DataFrame | None:
    """Run a spec; ``order_by`` is the total order in which "first row" is meant."""
    if df is None:
        return None
    # Records with shifted or cut values are kept apart (``extracts.quarantine``), not cleaned.
    df = S.drop_empty_columns(fitting(df), keep=order_by)
    if spec.naming is not None:
        df = _on_body(df, spec.naming)
    df = S.rename_existing(df, spec.rename)
    df = df.withColumnsRenamed({c: c.replace(".", "_") for c in df.columns})
    if spec.questions:
        df = S.label_questions(df, spec.questions)
    text = [c for c in S.text_columns(df) if c not in order_by]
    df = E.squish_text(df, text) if spec.squish else E.trim_text(df)
    for column, prefix in spec.weeks.items():
        if column in df.columns:
            df = V.parse_calendar_week(df, column, prefix)
    df = V.excel_serial_to_timestamp(df, spec.serial_timestamps)
    percent = [c for c in spec.percent if c in S.text_columns(df)]
    if percent:
        df = df.withColumns({c: percent_points(F.col(c)) for c in percent})
    df = V.convert_types(df, conversion_spec(df, spec, order_by), keep_unparsed=True)
    for step in spec.derive:
        df = step(df)
    df = E.dedupe_by_available(df, spec.dedupe, order_by)
    df = S.ids_as_string(df, spec.ids) if spec.ids else df
    return df.drop(*POSITION)


def conversion_spec(df: DataFrame, spec: CleanSpec, skip: Sequence[str] = POSITION) -> V.ConversionSpec:
    """The type plan of a spec for the columns that are really there."""
    taken = [*skip, *spec.serial_timestamps]
    kinds: dict[str, tuple[str, ...]] = {}
    for kind in ("timestamps", "mixed_dates", "dates", "numeric", "logical", "category"):
        kinds[kind] = _named(df, getattr(spec, kind), taken)
        taken += kinds[kind]
    return V.ConversionSpec(**kinds)


# --------------------------------------------------------------------------
# Derived columns, each added only when its inputs were typed successfully
# --------------------------------------------------------------------------

_TEMPORAL = (DateType, TimestampType, TimestampNTZType)


def _temporal(df: DataFrame, *columns: str) -> bool:
    kinds = {f.name: f.dataType for f in df.schema}
    return all(isinstance(kinds.get(c), _TEMPORAL) for c in columns)


def _parts(df: DataFrame, column: str, prefix: str, parts: Sequence[str]) -> DataFrame:
    return E.date_parts(df, column, prefix, parts) if _temporal(df, column) else df


def _span_days(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    if not _temporal(df, start, end):
        return df
    return flag_date_inconsistency(E.duration_days(df, start, end, out), start, end)


def _span_minutes(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    return E.duration_minutes(df, start, end, out) if _temporal(df, start, end) else df


def _office(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    return E.business_hours_flag(df, column, first, last) if _temporal(df, column) else df


def _subject(df: DataFrame) -> DataFrame:
    return E.subject_features(df) if "subject" in df.columns else df


def _warranty(df: DataFrame, as_of: str) -> DataFrame:
    column = "warranty_end_date_reg_prod"
    return E.warranty_status(df, column, as_of) if _temporal(df, column) else df


def _completeness(df: DataFrame) -> DataFrame:
    position = [c for c in POSITION if c in df.columns]
    scored = row_completeness(df.drop(*position)).columns[-1]
    present = sum((F.col(c).isNotNull().cast("int") for c in df.columns if c not in position), F.lit(0))
    return df.withColumn(scored, present / F.lit(float(len(df.columns) - len(position))))


def _survey(df: DataFrame) -> DataFrame:
    items = E.likert_columns(df, exclude=[*POSITION, "software_generation"])
    typed = df.withColumns({c: F.col(c).try_cast("double").cast("int") for c in items}) if items else df
    return E.response_quality(E.likert_scores(typed, items), items)


_YMD = ("year", "month", "day")

OPPORTUNITIES = CleanSpec(
    naming=S.snake_names,
    rename={
        "id": "to_id",
        "customer_id": "to_customer_id",
        "account": "to_customer_name",
        "start_date": "to_start_date",
        "close_date": "to_close_date",
        "sales_phase": "to_sales_phase",
        "opportunity_status": "to_opportunity_status",
        "expected_value": "to_expected_value",
        "product_category": "to_product_category",
        "probability": "to_probability",
        "weighted_value": "to_weighted_value",
    },
    squish=False,
    numeric=("^to_expected_value$", "^price_of_competitor_machine$", "^to_weighted_value$"),
    dates=("date$|time$|on$",),
    mixed_dates=("^to_(start|close)_date$", "^expected_closure_date$"),
    serial_timestamps=("changed_on", "created_on"),
    percent=("to_probability",),
    category=("^to_sales_phase$", "^to_opportunity_status$", "^to_product_category$"),
    derive=(
        partial(_parts, column="to_start_date", prefix="to_start", parts=("year", "quarter", "month")),
        partial(_parts, column="to_close_date", prefix="to_close", parts=("year", "quarter", "month")),
        partial(_span_days, start="to_start_date", end="to_close_date", out="to_duration_in_days"),
    ),
    dedupe=(("to_id", "to_start_date", "to_close_date"), ("to_id",)),
    ids="^to_customer_id$",
)

QUOTES = CleanSpec(
    naming=S.snake_names,
    rename={
        "id": "tq_id",
        "progress": "tq_progress",
        "status": "tq_status",
        "description": "tq_description",
        "account": "tq_customer",
        "customer_id": "tq_customer_id",
        "total": "tq_total_value",
        "date": "tq_date",
        "owner": "tq_owner",
        "territory": "tq_territory",
        "opportunity": "tq_opportunity",
        "created_on": "tq_creation_date",
    },
    numeric=("total|value|price|amount",),
    dates=("date$|time$|on$",),
    category=("status$|progress$|phase",),
    derive=(partial(_parts, column="tq_date", prefix="tq", parts=("year",)),),
    dedupe=(("tq_id", "tq_date"), ("tq_id",)),
    ids="^tq_customer_id$",
)

SOFTWARE_SALES = CleanSpec(
    naming=None,
    rename={
        "geschaftsj_periode": "ts_year_raw",
        "gultig_ab": "ts_pur_date",
        "geschaftsjahr": "ts_fin_year",
        "land_auftraggeber": "ts_country_buyer",
        "land": "ts_country",
        "endkunde": "ts_customer_id",
        "kunde": "ts_customer_name",
        "x4_produkttype": "ts_product_type",
        "x5_generation": "ts_generation",
        "x6_produktoptionen": "ts_product_options",
        "x7_lokale_sicht": "ts_product_details",
        "material": "ts_material_num",
        "position": "ts_position",
        "umsatz": "ts_revenue",
    },
    numeric=("^ts_revenue$", "^ts_year_raw$", "^ts_position$"),
    dates=("^ts_pur_date$",),
    category=("^ts_country$", "^ts_country_buyer$", "^ts_product_type$", "^ts_generation$"),
    derive=(partial(_parts, column="ts_pur_date", prefix="ts", parts=("year",)),),
    ids="^ts_customer_id$",
)

MACHINE_ORDERS = CleanSpec(
    naming=S.snake_names,
    rename={
        "bezeichnung": "sm_description",
        "equipmentnummer": "sm_equipment_number",
        "anschaffungsdatum": "sm_purchase_date",
        "landerschlussel.x": "sm_country_code_x",
        "material": "sm_material",
        "name_1": "sm_name",
        "nummer_vertriebsauftrag": "sm_sales_order_number",
        "vertriebssachbearbeiter": "sm_sales_rep",
        "datum_rot": "sm_date_rot",
        "hersteller_der_anlage_werk": "sm_manufacturer",
        "fakturadatum": "sm_invoice_date",
        "auftrageingangsdatum": "sm_order_entry_date",
        "angelegt_am": "sm_created_at",
        "warenausgangsdatum": "sm_shipping_date",
        "submission": "sm_submission",
        "nettowert": "sm_net_value",
        "belegwahrung": "sm_document_currency",
        "position_sd": "sm_position_sd",
        "partnerrolle": "sm_partner_role",
        "debitor": "sm_debtor",
        "landerschlussel.y": "sm_country_code_y",
        "adresskennzeichen": "sm_address_marker",
    },
    numeric=("^sm_net_value$", "^sm_position_sd$"),
    mixed_dates=("^sm_purchase_date$",),
    dates=("^sm_.*_date$", "^sm_date_rot$", "^sm_created_at$"),
    category=("^sm_partner_role$", "^sm_document_currency$", "^sm_country_code_[xy]$"),
    derive=(partial(_parts, column="sm_purchase_date", prefix="purchase", parts=_YMD),),
    dedupe=(("sm_equipment_number", "sm_purchase_date"), ("sm_equipment_number",)),
    ids="^sm_equipment_number$",
)

INSTALLED_BASE = CleanSpec(
    rename={
        "equipment_number": "sis_equipment_number",
        "equipment_type": "sis_equipment_type",
        "equipment_group": "sis_equipment_group",
        "country_code": "sis_country_code",
        "start_up_1_date": "sis_start_date",
        "start_up_2_date": "sis_install_date",
        "reseller_warranty_start": "sis_reseller_warranty_start",
        "reseller_warranty_end": "sis_reseller_warranty_end",
        "customer_number": "sis_customer_number",
        "customer_warranty_start": "sis_customer_warranty_start",
        "customer_warranty_end": "sis_customer_warranty_end",
        "summe_von_duration_years": "sis_duration_years",
    },
    numeric=("^sis_duration_years$",),
    dates=("^sis_(start|install)_date$", "^sis_.*_warranty_(start|end)$"),
    category=("^sis_equipment_type$", "^sis_equipment_group$", "^sis_country_code$"),
    derive=(
        partial(_parts, column="sis_start_date", prefix="construction", parts=_YMD),
        partial(_parts, column="sis_install_date", prefix="installation", parts=_YMD),
    ),
    dedupe=(("sis_equipment_number",),),
    ids="^sis_(customer|equipment)_number$",
)

CASES = CleanSpec(
    rename={
        "case_number": "sc_case_number",
        "case_type": "sc_case_type",
        "priority": "sc_priority",
        "equipment_number": "sc_equipment_number",
        "nsc_status": "sc_nsc_status",
        "organization_of_editor": "sc_org_editor",
        "group_of_editor": "sc_group_editor",
        "customer_number": "sc_customer_number",
        "customer_name": "sc_customer_name",
        "organization_of_creator": "sc_org_creator",
        "cw": "sc_cw",
        "solved_inhouse": "sc_solved_inhouse",
        "count_of_missions": "sc_count_of_missions",
        "escalation": "sc_escalation",
        "reaction_time": "sc_reaction_time",
        "summe_von_delayed_callbacks": "sc_delayed_callbacks",
        "case_billed": "sc_case_billed",
    },
    weeks={"sc_cw": "case"},
    numeric=("^sc_reaction_time$", "^sc_delayed_callbacks$", "^sc_count_of_missions$"),
    logical=("^sc_solved_inhouse$", "^sc_escalation$", "^sc_case_billed$"),
    category=("^sc_case_type$", "^sc_priority$", "^sc_nsc_status$"),
    dedupe=(("sc_case_number",),),
    ids="^sc_(customer|equipment)_number$",
)

MISSIONS = CleanSpec(
    weeks={"cw": "mission"},
    numeric=("^waiting_time_days$", "^working_time_h$", "^travel_time_h$"),
    logical=("^missions_delayed$",),
    category=("^priority$", "^mission_type$", "^billing_type$"),
    dedupe=(("mission_id",),),
    ids="^mission_id$|^case_number$",
)

CUSTOMERS = CleanSpec(
    rename={"account_id": "customer_account_id", "sap_id": "customer_sap_id", "name": "customer_name"},
    dedupe=(("customer_account_id",),),
    ids="^customer_(account|sap)_id$",
)

CONTACTS = CleanSpec(
    dates=("date|created|changed",),
    derive=(_completeness,),
    dedupe=(("id", "account_id"), ("contact_id", "account_id"), ("id",), ("contact_id",)),
    ids="^account_id$",
)

MEETINGS = CleanSpec(
    timestamps=("^(start|end)_date_time$", "^(last_)?changed_on$", "^created_on$"),
    dates=("date|time|created|changed",),
    derive=(
        partial(_span_minutes, start="start_date_time", end="end_date_time", out="meeting_duration_minutes"),
        partial(_parts, column="start_date_time", prefix="meeting_starting", parts=(*_YMD, "time")),
        partial(_parts, column="start_date_time", prefix="meeting", parts=("weekday",)),
    ),
    dedupe=(("id",),),
    ids="^account_id$",
)

MAILS = CleanSpec(
    timestamps=("^sent_on$", "date|time|sent|created|changed"),
    derive=(
        partial(_parts, column="sent_on", prefix="sent", parts=(*_YMD, "time", "weekday", "hour")),
        partial(_office, column="sent_on", first=8, last=17),
        _subject,
    ),
    dedupe=(("id",),),
    ids="^account_id$",
)

OTHER_ACTIVITIES = CleanSpec(
    timestamps=("date|time|created|changed",),
    derive=(
        partial(_span_minutes, start="start_date_time", end="end_date_time", out="activity_duration_minutes"),
        partial(_parts, column="start_date_time", prefix="activity", parts=(*_YMD, "weekday", "hour")),
        partial(_office, column="start_date_time", first=9, last=17),
    ),
    dedupe=(("id",),),
    ids="^account_id$",
)

SURVEY = CleanSpec(
    naming=S.clean_question_names,
    questions={
        "software_generation": "software_from_sap",
        "core_competency": "is_the_offering_close_to_.*core_competency",
        "hardware_proximity": "is_the_offering_close_to_hardware",
        "performance_improvement": "after_implementation_how_much_do_.*performance_improve",
        "customer_lock_in": "after_implementation_how_strong_is_a_customers_lock_in.*",
        "investment_level": "how_long_does_it_take_for_customers_to_use_the_software.*",
        "implementation_time": "how_long_does_it_take_for_customers_to_use_the_software.*",
        "explanation_needed": "how_much_explanation_does_the_software_need",
        "competitor_count": "how_many_competitor_products_do_exist",
        "competitor_quality": "how_would_you_rate_the_competitions_best_alternative",
        "third_party_integration": "how_easy_can_non_.*be_integrated_with_the_software",
        "third_party_functionality": "how_would_you_rate_the_functional_scope_of_the_software.*",
    },
    squish=False,
    derive=(_survey,),
)


def registered_products(as_of: str) -> CleanSpec:
    """Warranty status is relative to ``as_of``, so a run can be repeated."""
    dates = ("reference", "warranty_end", "shipping", "completion")
    return CleanSpec(
        dates=("date|time|warranty|shipping|completion|created",),
        derive=(
            *[partial(_parts, column=f"{d}_date_reg_prod", prefix=d, parts=_YMD) for d in dates],
            partial(_warranty, as_of=as_of),
        ),
        dedupe=(("id_reg_prod",), ("serial_id_reg_prod",)),
        ids="account_id|customer_id|^serial_id_reg_prod$",
    )


def clean_specs(as_of: str) -> dict[str, CleanSpec]:
    return {
        "opportunities": OPPORTUNITIES,
        "quotes": QUOTES,
        "software_sales": SOFTWARE_SALES,
        "machine_orders": MACHINE_ORDERS,
        "installed_base": INSTALLED_BASE,
        "cases": CASES,
        "missions": MISSIONS,
        "customers": CUSTOMERS,
        "contacts": CONTACTS,
        "meetings": MEETINGS,
        "mails": MAILS,
        "other_activities": OTHER_ACTIVITIES,
        "registered_products": registered_products(as_of),
        "survey": SURVEY,
    }


def clean_all(
    datasets: Mapping[str, DataFrame], as_of: str, order_by: Sequence[str] = POSITION
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Clean every dataset; a failing one is reported and does not stop the others."""
    cleaned, errors = {}, {}
    specs = clean_specs(as_of)
    for name, df in datasets.items():
        try:
            cleaned[name] = clean(df, specs[name], order_by)
        except Exception as error:  # noqa: BLE001 - isolation per dataset is the feature
            errors[name] = f"{type(error).__name__}: {error}"
    return cleaned, errors


def without(spec: CleanSpec, **changes) -> CleanSpec:
    """A variant of a spec, for example for an extract with its own column names."""
    return replace(spec, **changes)
