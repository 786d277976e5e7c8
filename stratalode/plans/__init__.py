"""Multi-step jobs: silver cleaning, gold indicators, and the whole daily run."""

from stratalode.plans.contract import (
    GOLD_TABLES,
    conform_to_schema,
    constraint_violations,
)
from stratalode.plans.daily import run_pipeline
from stratalode.plans.gold import build_gold, write_gold_tables
from stratalode.plans.gold_states import (
    changed_carts,
    compact_gold_states,
    gold_from_states,
    update_gold_states,
)
from stratalode.plans.indicators import (
    category_performance,
    product_performance,
    sales_daily,
    sales_view,
    top10_products_revenue,
    user_ltv,
)
from stratalode.plans.silver import (
    process_and_flatten,
    process_table,
    process_tables,
    silver_carts,
    silver_products,
)
from stratalode.plans.uniqueness import constraint_violations_incremental, stored_violations

__all__ = [
    "GOLD_TABLES",
    "build_gold",
    "category_performance",
    "changed_carts",
    "compact_gold_states",
    "conform_to_schema",
    "constraint_violations",
    "constraint_violations_incremental",
    "gold_from_states",
    "process_and_flatten",
    "process_table",
    "process_tables",
    "product_performance",
    "run_pipeline",
    "sales_daily",
    "sales_view",
    "silver_carts",
    "silver_products",
    "top10_products_revenue",
    "stored_violations",
    "update_gold_states",
    "user_ltv",
    "write_gold_tables",
]
