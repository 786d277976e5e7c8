"""The daily run: bronze, silver, gold."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from stratalode.plans.gold import build_gold, write_gold_tables
from stratalode.plans.gold_states import gold_from_states, update_gold_states
from stratalode.plans.indicators import CreatedAt
from stratalode.plans.parallel import side_by_side
from stratalode.plans.silver import RAW_SCHEMAS, process_tables
from stratalode.sinks.files import land_bronze_json
from stratalode.sinks.stage import staging
from stratalode.sources.dated import ExecutionDate, as_date, scan_execution_date, scan_partitioned_root
from stratalode.sources.files import scan_parquet


def run_pipeline(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    execution_date: ExecutionDate = None,
    created_at: CreatedAt = None,
    subdomain: str = "",
    snapshot: str = "latest",
    incremental: bool = False,
) -> dict[str, str]:
    """Land raw tables, clean ``products`` and ``carts``, and write the indicators.

    Layers run one after another and hand over through storage below ``root``, raw tables
    as gzipped JSON; an error stops the run before the next layer. Gold reads the silver rows just
    written, as each day holds the full tables, or of a table without rows that
    day the newest ones before; ``snapshot="all"`` reads every day up to this one.
    Running a day again replaces its files. Returns the gold paths.

    With ``incremental=True`` the day's ``carts`` are those that are new or changed
    since the last run, and a raw table ``deleted_carts`` (``id``) may name carts
    that are gone. Gold is then made from the states in ``gold_states``, see
    `update_gold_states`, instead of all cart lines; its rows are the same.
    """
    execution_date = as_date(execution_date)  # once, so that a run over midnight stays with its day
    bronze, silver, gold = (f"{root.rstrip('/')}/{zone}" for zone in ("bronze", "silver", "gold"))
    side_by_side(
        spark, lambda table: land_bronze_json(raw[table], bronze, table, execution_date, compression="gzip"), raw
    )
    written = process_tables(
        spark,
        bronze,
        silver,
        ["products", "carts"],
        execution_date,
        schemas=RAW_SCHEMAS,
        subdomain=subdomain,
    )
    prefix = f"{subdomain}_" if subdomain else ""

    def read(table: str) -> DataFrame:
        root = f"{silver}/{prefix}{table}"
        if snapshot == "all":
            return scan_partitioned_root(spark, root, before=as_date(execution_date) + datetime.timedelta(days=1))
        if written[table] is not None:
            return scan_parquet(spark, written[table], base_path=root)
        day_after = as_date(execution_date) + datetime.timedelta(days=1)
        return scan_partitioned_root(spark, root, "latest", before=day_after)

    if snapshot not in ("all", "latest"):
        raise ValueError(f"snapshot must be 'all' or 'latest', not {snapshot!r}")
    products = read("products")
    if incremental:
        states = f"{root.rstrip('/')}/gold_states"
        carts = read("carts") if written["carts"] is not None else read("carts").limit(0)
        deleted = scan_execution_date(spark, bronze, "deleted_carts", execution_date, schema="id bigint") if "deleted_carts" in raw else None
        update_gold_states(spark, carts, states, execution_date, deleted, staged=False)
        with staging(spark) as stage:
            frames = gold_from_states(spark, states, products, execution_date, created_at, stage=stage, for_writing=True)
            return write_gold_tables(frames, gold)
    carts = read("carts")
    with staging(spark) as stage:
        # A day's silver lines come from one document per cart; those of several days may not.
        frames = build_gold(carts, products, created_at, stage=stage, whole_carts=snapshot == "latest")
        return write_gold_tables(frames, gold)
