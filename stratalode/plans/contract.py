"""The declared shape of the gold tables, and checks against it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalode.functions.names import as_list, column, lookup, spare_name


@dataclass(frozen=True)
class TableContract:
    columns: str
    keys: tuple[str, ...]
    required: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


# Columns, types, primary keys and NOT NULL columns of the gold tables.
GOLD_TABLES = {
    "top10_products_revenue": TableContract(
        "product_id bigint, product_name string, category string, unit_price double, "
        "total_units_sold bigint, total_revenue double",
        keys=("product_id",),
        required=("product_name",),
    ),
    "sales_daily": TableContract(
        "date timestamp, total_revenue double, total_orders bigint, total_items bigint, "
        "avg_ticket double, created_at timestamp",
        keys=("date",),
        required=("total_revenue", "total_orders", "total_items"),
    ),
    "product_performance": TableContract(
        "product_id bigint, product_title string, category string, total_quantity bigint, "
        "total_revenue double, avg_price double, rating_rate double, rating_count bigint, "
        "created_at timestamp",
        keys=("product_id",),
        required=("product_title",),
    ),
    "category_performance": TableContract(
        "category string, total_revenue double, total_quantity bigint, "
        "revenue_share_pct double, created_at timestamp",
        keys=("category",),
        required=("total_revenue", "total_quantity"),
    ),
    "user_ltv": TableContract(
        "user_id bigint, total_orders bigint, total_items bigint, total_revenue double, "
        "avg_ticket double, customer_type string, created_at timestamp",
        keys=("user_id",),
        required=("total_orders", "total_items", "total_revenue", "customer_type"),
    ),
}


def conform_to_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Bring a frame to declared columns: their names, order and types.

    Columns that are not declared are left out. A declared column the frame
    lacks is an error.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    sources = {f.name: lookup(df.columns, f.name) for f in schema.fields}
    missing = [name for name, source in sources.items() if source is None]
    if missing:
        raise ValueError(f"declared columns missing from the frame: {missing}")
    return df.select(
        *[column(sources[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def constraint_violations(
    df: DataFrame, keys: str | Iterable[str], required: str | Iterable[str] | None = None
) -> DataFrame:
    """Report broken keys and missing values.

    One row per violated rule and key: the rule (``primary_key`` or
    ``not_null``), the column, the key's text and the number of rows concerned.
    Key columns count as required. One aggregation by key answers all rules;
    rows are counted per task before they are shuffled.
    """
    keys = as_list(keys)
    checked = list(dict.fromkeys([*keys, *as_list(required)]))
    rows = spare_name(keys, "rows")
    nulls = {c: spare_name(keys, f"nulls_{i}") for i, c in enumerate(checked)}
    counted = df.groupBy(*map(column, keys)).agg(
        F.count("*").alias(rows),
        *[F.count_if(column(c).isNull()).alias(name) for c, name in nulls.items()],
    )
    return broken_rules(counted, {k: k for k in keys}, rows, nulls)


def broken_rules(counted: DataFrame, keys: Mapping[str, str], rows: str, nulls: Mapping[str, str]) -> DataFrame:
    """The findings among counted keys.

    ``keys`` and ``nulls`` give the column of ``counted`` that holds a key column or
    the number of NULLs of a checked one, ``rows`` the one with the number of rows.
    """
    key_is_whole = reduce(and_, [column(k).isNotNull() for k in keys.values()])

    def finding(rule: str, name: str, broken: Column, count: str):
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(name).alias("column_name"),
            F.when(broken, column(count)).alias("row_count"),
        )

    findings = [
        finding("primary_key", ",".join(keys), key_is_whole & (column(rows) > 1), rows),
        *[finding("not_null", c, column(name) > 0, name) for c, name in nulls.items()],
    ]
    key_text = F.concat_ws(",", *[F.coalesce(column(k).cast("string"), F.lit("NULL")) for k in keys.values()])
    broken = reduce(or_, [column(name) > 0 for name in nulls.values()], column(rows) > 1)
    # Filtered as rows: a lambda over the array is not compiled, and took most of the time.
    rules = counted.filter(broken).select(key_text.alias("key"), F.inline(F.array(*findings)))
    return rules.filter("row_count is not null").select("rule", "column_name", "key", "row_count")
