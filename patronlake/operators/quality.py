"""Record contracts and data-quality rules; all rules of a table run in one pass over it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlake import schemas as S


@dataclass(frozen=True)
class Contract:
    """What a clean table promises: columns, types, presence, vocabularies, minima."""

    spec: S.TableSpec
    words: Mapping[str, list[str]]
    minimum: Mapping[str, int]

    def rules(self) -> dict[str, Column]:
        """Rule name → condition that marks a violating row."""
        nullable = set(self.spec.columns) - set(self.spec.required)
        rules = {f"{c} required": F.col(c).isNull() for c in self.spec.required}
        for c, allowed in self.words.items():
            bad = ~F.col(c).isin(*allowed)
            rules[f"{c} in vocabulary"] = bad if c in nullable else bad | F.col(c).isNull()
        for c, least in self.minimum.items():
            rules[f"{c} at least {least}"] = F.col(c) < least
        return rules


CONTRACTS = {
    "dim_users": Contract(S.DIM_USERS, {"loyalty_tier": S.LOYALTY_TIERS}, {}),
    "dim_products": Contract(S.DIM_PRODUCTS, {}, {"cost_price": 0}),
    "fact_orders": Contract(
        S.FACT_ORDERS,
        {"order_status": S.ORDER_STATUSES, "payment_method": S.PAYMENT_METHODS},
        {"total_amount": 0},
    ),
    "fact_order_items": Contract(S.FACT_ORDER_ITEMS, {}, {"quantity": 0, "unit_price": 0}),
    "fact_events_log": Contract(
        S.FACT_EVENTS_LOG, {"event_type": S.EVENT_TYPES}, {"time_spent_seconds": 0}
    ),
    "fact_cs_tickets": Contract(S.FACT_CS_TICKETS, {"issue_category": S.ISSUE_CATEGORIES}, {}),
    "customer_360": Contract(
        S.CUSTOMER_360,
        {"loyalty_tier": S.LOYALTY_TIERS},
        {
            "total_lifetime_value": 0,
            "total_orders_completed": 0,
            "total_abandoned_carts": 0,
            "total_cs_complaints": 0,
        },
    ),
}

# The seven checks that the clean zone must always pass.
QUALITY_RULES = {
    "dim_users": {
        "user_id not null": lambda: F.col("user_id").isNull(),
        "loyalty_tier known or null": lambda: ~F.col("loyalty_tier").isin(*S.LOYALTY_TIERS),
    },
    "fact_orders": {
        "order_status known": lambda: F.col("order_status").isNull()
        | ~F.col("order_status").isin(*S.ORDER_STATUSES),
        "total_amount not negative": lambda: F.col("total_amount") < 0,
    },
    "fact_events_log": {
        "event_type known": lambda: F.col("event_type").isNull()
        | ~F.col("event_type").isin(*S.EVENT_TYPES),
    },
    "fact_cs_tickets": {
        "rating within 1 to 5": lambda: ~F.col("rating").between(1, 5),
        "issue_category known or null": lambda: ~F.col("issue_category").isin(*S.ISSUE_CATEGORIES),
    },
}


def schema_faults(df: DataFrame, contract: Contract) -> list[str]:
    """Differences between the columns of a DataFrame and its contract. Reads no data."""
    found = {f.name: f.dataType for f in df.schema.fields}
    declared = {f.name: f.dataType for f in contract.spec.schema.fields}
    faults = [f"{c} is missing" for c in contract.spec.required if c not in found]
    faults += [f"{c} is not part of the contract" for c in found if c not in declared]
    for name, kind in declared.items():
        if name in found and not _same_family(found[name], kind):
            faults.append(f"{name} is {found[name].simpleString()}, not {kind.simpleString()}")
    return faults


def _same_family(found: T.DataType, declared: T.DataType) -> bool:
    """Widths may differ (a short is an integer); kinds may not. An untyped NULL fits anything."""
    families = (
        (T.StringType,), (T.IntegralType,), (T.DecimalType,), (T.FractionalType,),
        (T.TimestampType, T.TimestampNTZType),
    )
    if isinstance(found, T.NullType):
        return True
    return any(isinstance(found, f) and isinstance(declared, f) for f in families)


def row_faults(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that break the contract, with the names of the broken rules."""
    present = set(df.columns)
    rules = {
        name: bad for name, bad in contract.rules().items() if name.split(" ", 1)[0] in present
    }
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return df.withColumn("broken_rules", broken).filter(F.size("broken_rules") > 0)


def violation_counts(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def contract_report(star, tables: list[str] | None = None) -> DataFrame:
    """(table, rule, violations) for every contract rule; one scan per table."""
    return _stack([
        violation_counts(getattr(star, name), name, CONTRACTS[name].rules())
        for name in tables or CONTRACTS
    ])


def dq_report(star) -> DataFrame:
    return _stack([
        violation_counts(
            getattr(star, name), name, {rule: bad() for rule, bad in rules.items()}
        )
        for name, rules in QUALITY_RULES.items()
    ])


def not_null_violations(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """NULLs in the NOT NULL columns of one table, as (table, column, violations)."""
    rules = {c: F.col(c).isNull() for c in spec.required}
    return violation_counts(df, spec.name, rules).withColumnRenamed("rule", "column_name")


def not_null_report(star, tables: list[str] | None = None) -> DataFrame:
    return _stack([
        not_null_violations(getattr(star, name), S.TABLES[name]) for name in tables or S.TABLES
    ])
