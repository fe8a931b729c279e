"""Panel construction: the dense grid, attributes and attaching measure tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom import config as C
from panelloom.config import PanelKeys
from panelloom.functions.logic import join_on_keys
from panelloom.operators.cleaning import dedupe_first
from panelloom.operators.schema import resolve_roles

YEARLY = PanelKeys()


def _shift(bound: object, by: int, keys: PanelKeys) -> Column:
    if keys.unit == "year":
        return F.lit(bound + by).cast("long")
    day = F.lit(bound).cast("date")
    return F.date_add(day, by) if keys.unit == "day" else F.add_months(day, by)


def first_event(
    events: DataFrame,
    entity: str,
    period: Column | str,
    lo: object,
    hi: object,
    keys: PanelKeys = YEARLY,
    slack: tuple[int, int] = (10, 5),
) -> DataFrame:
    """First period per entity; entities far outside the range ``lo``..``hi`` are left out.

    An entity without any known period has no first period and is left out too.
    """
    period = F.col(period) if isinstance(period, str) else period
    firsts = events.groupBy(F.col(entity).alias(keys.entity)).agg(F.min(period).alias("first_interaction"))
    return firsts.filter(F.col("first_interaction").between(_shift(lo, -slack[0], keys), _shift(hi, slack[1], keys)))


def base_panel(firsts: DataFrame, lo: object, hi: object, keys: PanelKeys = YEARLY) -> DataFrame:
    """Entity x period grid with the relationship status.

    The periods are generated on each entity's row: no cross join and no join back.
    """
    start, stop = _shift(lo, 0, keys), _shift(hi, 0, keys)
    step = None if keys.unit == "year" else F.expr(f"INTERVAL 1 {keys.unit.upper()}")
    periods = F.sequence(start, stop) if step is None else F.sequence(start, stop, step)
    others = [c for c in firsts.columns if c not in (keys.entity, "first_interaction")]
    before = F.col(keys.period) < F.col("first_interaction")
    return firsts.select(
        keys.entity, F.explode(periods).alias(keys.period), "first_interaction", *others
    ).withColumn("relationship_status", F.when(before, C.PRE).otherwise(C.ACTIVE))


def attributes_from(source: DataFrame, entity: str, order_by: Sequence[str], keys: PanelKeys = YEARLY) -> DataFrame:
    """First row per entity of name, model, sector, class and country, as far as present."""
    roles = resolve_roles(source, "attributes")
    picked = source.select(
        F.col(entity).alias(keys.entity),
        *[F.col(column).alias(role) for role, column in roles.items()],
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order_by)],
    )
    order = [f"_order{i}" for i in range(len(order_by))]
    return dedupe_first(picked, [keys.entity], order).drop(*order)


def add_secondary_id(attributes: DataFrame, customers: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """Attach the customer table's second id: the least one where an entity has several."""
    roles = resolve_roles(customers, "customers", ["entity", "secondary_id"])
    kind = attributes.schema[keys.entity].dataType
    ids = customers.groupBy(F.col(roles["entity"]).cast(kind).alias(keys.entity)).agg(
        F.min(roles["secondary_id"]).alias("customer_sap_id")
    )
    return join_on_keys(attributes, ids, [keys.entity])


def add_attributes(panel: DataFrame, attributes: DataFrame, keys: PanelKeys = YEARLY) -> DataFrame:
    """Attach per-entity attributes. On the entity list, before the grid is spread out,
    this joins one row per entity instead of one per entity and period."""
    return join_on_keys(panel, attributes, [keys.entity])


def attach_measures(
    panel: DataFrame, measures: DataFrame, on: str | None = None, keys: PanelKeys = YEARLY
) -> DataFrame:
    """Left-join one measure table; the row count of the panel never changes.

    Entity keys match NULL with NULL. A secondary id given by ``on`` uses plain equality
    (an unmapped entity must not receive the unmapped measures), with panel rows lacking
    it spread over tasks by a salt that cannot match.
    """
    if on is None:
        return join_on_keys(panel, measures, [keys.entity, keys.period])
    salt = F.when(F.col(on).isNull(), F.pmod(F.xxhash64(keys.entity), F.lit(997)) + 1).otherwise(0)
    left = panel.withColumn("_salt", salt.cast("long"))
    right = measures.withColumnsRenamed({keys.entity: on}).withColumn("_salt", F.lit(0).cast("long"))
    return left.join(right, [on, keys.period, "_salt"], "left").drop("_salt")


def rekey_measures(measures: DataFrame, mapping: DataFrame, on: str, keys: PanelKeys = YEARLY) -> DataFrame:
    """Measures keyed by a secondary id (in the entity column) moved to the entity key.

    ``mapping`` has one row per entity with the secondary id in ``on``. Doing this on the
    measure side leaves the panel's partitioning alone.
    """
    kind = mapping.schema[on].dataType
    by_id = measures.withColumn(keys.entity, F.col(keys.entity).cast(kind)).withColumnsRenamed({keys.entity: on})
    known = mapping.select(keys.entity, on).filter(F.col(on).isNotNull())
    return by_id.join(known, on, "inner").drop(on)


def align_measures(panel: DataFrame, tables: Sequence[DataFrame], keys: PanelKeys = YEARLY) -> DataFrame:
    """Attach many (entity, period) tables with a single exchange.

    Panel and tables are stacked by name, hashed by entity once and folded to one row per
    key; every table has at most one row per key, so ``max`` just picks it. The result is
    already partitioned the way the window features need, and NULL entities match.
    """
    clash = [c for i, t in enumerate(tables) for o in [panel, *tables[:i]] for c in t.columns
             if c in o.columns and c not in (keys.entity, keys.period)]
    if clash:
        raise ValueError(f"measure columns appear twice: {sorted(set(clash))}")
    types = {c: panel.schema[c].dataType for c in (keys.entity, keys.period)}
    parts = [panel.withColumn("_in_panel", F.lit(True))]
    parts += [t.withColumns({c: F.col(c).cast(kind) for c, kind in types.items()}) for t in tables]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in stacked.columns if c not in types]
    return (
        stacked.repartition(F.col(keys.entity))
        .groupBy(keys.entity, keys.period)
        .agg(*[F.max(c).alias(c) for c in values])
        .filter("_in_panel")
        .drop("_in_panel")
    )


def mask_inactive(df: DataFrame, columns: Iterable[str], status: str = "relationship_status") -> DataFrame:
    """Measures are unknown before the relationship and 0 by default while it is active."""
    known = "CASE WHEN {status} = '{active}' THEN coalesce(`{c}`, 0) END"
    return df.withColumns({c: F.expr(known.format(status=status, active=C.ACTIVE, c=c)) for c in columns})


def zero_missing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """No record means 0 (the rule of the small panel)."""
    return df.withColumns({c: F.expr(f"coalesce(`{c}`, 0)") for c in columns})
