"""The whole way from extracts to the stored panel, one stored layer per stage.

``ingest`` lands every dataset as text (layer ``interim``), ``clean_layer`` types and cleans
it (``processed``), and ``build`` writes the finished panel (``final``). Each stage reads the
previous layer back from Parquet, so a lost executor never has to start from the extracts.

Every dataset of a stage is a step of its own (``sources.steps``): one whose files, settings and code
are as they were is not read again, and a changed file rebuilds only what was made from it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.config import PanelSpec
from panelloom.plans.cleaners import clean, clean_specs
from panelloom.plans.panels import PanelInputs, build_panel, with_text_ids
from panelloom.sources import extracts as X
from panelloom.sources import layers as L
from panelloom.sources.steps import files_digest, reused, step_key

# Key columns that tie machine orders to their headers and partner roles.
ORDER_KEY, HEADER_KEY, PARTNER_KEY = "nummer_vertriebsauftrag", "verkaufsbeleg", "vertriebsbeleg"
#: Extracts that only enrich another one.
SIDES = ("order_headers", "order_partners")
PANEL_SOURCES = ("software_sales", "meetings", "mails", "other_activities", "cases", "missions", "installed_base", "registered_products")


def ingest(spark: SparkSession, specs: Mapping[str, X.SourceSpec], root: str) -> dict[str, str]:
    """Land all extracts that exist; machine orders are enriched on the way.

    Records that do not fit their header are stored by dataset in the layer ``quarantine``.
    """
    seen = {name: files_digest(spark, s.root, s.glob, s.recursive) for name, s in specs.items()}
    landed = {}
    for name, spec in specs.items():
        if seen[name] == "absent":
            X.load_source(spark, spec)  # reports it
            continue
        sides = [s for s in SIDES if name == "machine_orders" and s in specs]

        def land(name=name, spec=spec, sides=sides) -> dict:
            loaded = X.load_source(spark, spec)
            if loaded is None:
                return {"landed": False}
            L.write_layer(X.quarantine(loaded), root, "quarantine", name)
            if name == "machine_orders":
                found = [X.load_source(spark, specs[s]) if s in sides else None for s in SIDES]
                found = [None if df is None else X.fitting(df).drop(*X.POSITION) for df in found]
                loaded = X.enrich_orders(loaded, *found, ORDER_KEY, HEADER_KEY, PARTNER_KEY)
            if name not in SIDES:
                L.write_layer(loaded, root, "interim", name)
            return {"landed": name not in SIDES}

        key = step_key("ingest", spec, seen[name], {s: (specs[s], seen[s]) for s in sides})
        if reused(spark, root, f"interim/{name}", key, land)[0]["landed"]:
            landed[name] = f"{root}/interim/{name}"
    return landed


def clean_layer(spark: SparkSession, root: str, as_of: str) -> tuple[DataFrame, dict[str, str]]:
    """Clean every landed dataset; returns row counts before and after, and the errors.

    A failing dataset is reported and does not stop the others; what it gave before is not kept
    as its result.
    """
    counts, errors = [], {}
    for name, spec in clean_specs(as_of).items():
        state = files_digest(spark, f"{root}/interim/{name}")
        if state == "absent":
            continue
        raw = L.read_layer(spark, root, "interim", name)

        def rows(df: DataFrame) -> int:
            return df.agg(F.count(F.lit(1))).first()[0]

        def tidy(name=name, spec=spec, raw=raw) -> dict:
            L.write_layer(clean(raw, spec), root, "processed", name)
            return {"raw": rows(raw), "cleaned": rows(L.read_layer(spark, root, "processed", name))}

        try:
            facts, _ = reused(spark, root, f"processed/{name}", step_key("clean", spec, as_of, state), tidy)
            counts.append((name, facts["raw"], facts["cleaned"], "success"))
        except Exception as error:  # noqa: BLE001 - isolation per dataset is the feature
            errors[name] = f"{type(error).__name__}: {error}"
            counts.append((name, rows(raw), None, "error"))
    summary = spark.createDataFrame(counts, "dataset string, rows_raw bigint, rows_cleaned bigint, status string")
    return summary, errors


def build(spark: SparkSession, root: str, spec: PanelSpec, name: str = "panel", run: str | None = None) -> dict[str, str]:
    """Build the panel from the processed layer and store it with metadata and summary; with ``run`` (a
    date, say) in a folder of its own."""
    wanted = ("opportunities", "customers", *PANEL_SOURCES)
    states = {source: files_digest(spark, f"{root}/processed/{source}") for source in wanted}

    def make() -> dict:
        data = with_text_ids(L.read_layers(spark, root, "processed", wanted))
        inputs = PanelInputs(
            opportunities=data["opportunities"],
            customers=data.get("customers"),
            **{source: data.get(source) for source in PANEL_SOURCES},
        )
        return L.write_panel(build_panel(inputs, spec), f"{root}/final", name, spec.keys, run)

    return reused(spark, root, f"final/{name}_{run}" if run else f"final/{name}", step_key("panel", spec, name, run, states), make)[0]
