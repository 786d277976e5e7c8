"""Incremental gold: the indicators from mergeable states instead of all cart lines.

A day brings whole carts that are new or changed, and ids of carts that are gone.
What the stored carts of these ids added is taken back, what the new ones add is
put in, so a day costs its changes and a look at the log for their ids, however
many carts are stored. Per day, three tables are kept below the states' root:

* ``cart_log``: the day's lines with their number of copies, negative for lines taken back;
* ``by_date`` and ``by_user``: signed sums of quantities, lines and carts per date or
  user and product. They hold no prices, so that gold follows the products it is
  built with, and they are whole numbers, so that nothing drifts.

The sum over all days is the state. A cart counts towards each date and user its
lines have, as ``count distinct`` counts it; NULL ids count as no cart and are
never replaced.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode.functions.values import rounded_ratio, run_timestamp
from stratalode.plans.contract import GOLD_TABLES, conform_to_schema
from stratalode.plans.indicators import (
    CreatedAt,
    customer_type,
    performance_of_categories,
    performance_of_products,
    rank_products,
)
from stratalode.plans.parallel import side_by_side
from stratalode.sinks.files import write_silver_parquet
from stratalode.sinks.stage import remove_folder, stage, staging
from stratalode.sources.dated import (
    ExecutionDate,
    as_date,
    date_folder,
    day_folders,
    day_is_complete,
    latest_partition,
    table_root,
)

LOG, BY_DATE, BY_USER = "cart_log", "by_date", "by_user"
STATES = (BY_DATE, BY_USER, LOG)  # the log is written last: a day is there once its log is
LINE = ("cart_id", "user_id", "date", "product_id", "quantity")
SUMS = ("quantity", "filled", "lines", "carts")


def _lines(carts: DataFrame) -> DataFrame:
    """Cart lines under the names of the log."""
    return carts.select(
        F.col("id").alias("cart_id"),
        F.col("userId").alias("user_id"),
        "date",
        F.col("products_productId").alias("product_id"),
        F.col("products_quantity").cast("bigint").alias("quantity"),
    )


def _net(signed: DataFrame) -> DataFrame:
    """Equal lines counted once, with their number of copies; those that cancel out are left out."""
    return signed.groupBy(*LINE).agg(F.sum("copies").alias("copies")).where("copies <> 0")


def _changes(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """Equal lines counted once, with their number of copies among the stored lines and the new ones.

    One aggregation serves the states and the log: lines that stay as they are are kept, as
    their carts are counted before and after.
    """
    none = F.lit(0).cast("bigint")
    both = new.withColumns({"before": none, "after": F.col("copies")})
    if old is not None:
        both = both.unionByName(old.withColumns({"before": F.col("copies"), "after": none}))
    counted = both.groupBy(*LINE).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    return counted.where("before <> 0 or after <> 0").withColumn("copies", F.col("after") - F.col("before"))


def _partial(changes: DataFrame, key: str) -> DataFrame:
    """Signed sums per ``key`` and product; the carts are counted on the row without a product."""
    copies, none = F.col("copies"), F.lit(0).cast("bigint")
    sums = changes.where("copies <> 0").select(
        key,
        "product_id",
        (copies * F.col("quantity")).alias("quantity"),
        F.when(F.col("quantity").isNotNull(), copies).alias("filled"),
        copies.alias("lines"),
        none.alias("carts"),
    )

    def held(copies: str) -> Column:
        return F.max(F.when(F.col(copies) > 0, 1).otherwise(0).cast("bigint"))

    counted = changes.where("cart_id is not null").groupBy("cart_id", key).agg((held("after") - held("before")).alias("carts"))
    counted = counted.where("carts <> 0").select(key, F.lit(None).cast("bigint").alias("product_id"), *[none.alias(c) for c in SUMS[:3]], "carts")
    return _added_up(sums.unionByName(counted), [key, "product_id"])


def _added_up(partials: DataFrame, keys: list[str]) -> DataFrame:
    """States merged: sums of sums. What has come to nothing is left out."""
    summed = partials.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    return summed.where(" or ".join(f"{c} <> 0" for c in SUMS))


def _base(table: str) -> str:
    return f"{table}_base"


def _folders_until(spark: SparkSession, root: str, table: str, last: datetime.date) -> list[str]:
    """The folders that make up a state of a day: the newest merged ones, and those of the days after, all finished."""
    base = latest_partition(spark, table_root(root, _base(LOG)), last + datetime.timedelta(days=1))
    first = base[0] + datetime.timedelta(days=1) if base else None
    found = list(day_folders(spark, table_root(root, LOG), first, last))
    begun = {day for name in STATES for day, _ in day_folders(spark, table_root(root, name), first, last)}
    broken = sorted(begun - {day for day, path in found if day_is_complete(spark, path)})
    if broken:
        raise ValueError(f"the states of {broken[0]} are not finished; run that day again first")
    merged = [f"{table_root(root, _base(table))}/{date_folder(base[0])}"] if base else []
    return merged + [f"{table_root(root, table)}/{date_folder(day)}" for day, _ in found]


def update_gold_states(
    spark: SparkSession,
    carts: DataFrame,
    root: str,
    execution_date: ExecutionDate = None,
    deleted: DataFrame | None = None,
    staged: bool = True,
) -> None:
    """Put a day's changed carts into the states below ``root``.

    ``carts`` holds the lines of the carts that are new or changed, each cart with
    all its lines; ``deleted`` the ``id`` of carts that are gone. A cart in both is
    changed, not gone. Ids that are not stored are added, or ignored when deleted.

    The lines are needed twice and are copied to the session's shared folder first;
    ``staged=False`` is for carts that are read from storage as they are.

    Running the newest day again replaces it. Earlier days cannot be run again, as
    later ones took back what they had put in; remove the later days first. Nor can
    days that `compact_gold_states` has merged.
    """
    day = as_date(execution_date)
    later = next(day_folders(spark, table_root(root, LOG), first=day + datetime.timedelta(days=1)), None)
    later = later or next(day_folders(spark, table_root(root, _base(LOG)), first=day), None)
    if later is not None:
        raise ValueError(f"the states of {later[0]} build on {day}; {day} cannot be run again on its own")
    with staging(spark) as keep:
        new = _lines(carts).withColumn("copies", F.lit(1).cast("bigint"))
        new = keep(new, "new-lines") if staged else new
        ids = new.select("cart_id")
        if deleted is not None:
            ids = ids.unionByName(deleted.select(F.col("id").alias("cart_id")))
        stored = _folders_until(spark, root, LOG, day - datetime.timedelta(days=1))
        old = spark.read.schema(new.schema).parquet(*stored).join(ids.distinct(), "cart_id", "left_semi") if stored else None
        changes = keep(_changes(new, old), "changed-lines")

        def write(item: tuple[str, str]) -> None:
            write_silver_parquet(_partial(changes, item[0]), root, item[1], day, skip_empty=False)

        side_by_side(spark, write, [("date", BY_DATE), ("user_id", BY_USER)])
        logged = changes.where("copies <> 0").select(*LINE, "copies")
        write_silver_parquet(logged, root, LOG, day, skip_empty=False)


def compact_gold_states(spark: SparkSession, root: str, execution_date: ExecutionDate = None) -> None:
    """Merge the states of all days up to one, so that later reads open one folder instead of one per day.

    Merged states lie beside the days' and count once their log is written, the last
    of the three; a run that fails before that changes nothing. The folders that
    have been merged are removed after it, and are not read even if they stay.
    """
    day = as_date(execution_date)
    if not _folders_until(spark, root, LOG, day):
        return
    merge = {
        BY_DATE: lambda rows: _added_up(rows, ["date", "product_id"]),
        BY_USER: lambda rows: _added_up(rows, ["user_id", "product_id"]),
        LOG: _net,
    }
    parts = {name: _folders_until(spark, root, name, day) for name in STATES}
    if len(parts[LOG]) == 1:
        return

    def write(name: str) -> None:
        write_silver_parquet(merge[name](spark.read.parquet(*parts[name])), root, _base(name), day, skip_empty=False)

    side_by_side(spark, write, (BY_DATE, BY_USER))
    write(LOG)
    for name in STATES:
        for path in parts[name]:
            remove_folder(spark, path)


def _totals(state: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """Revenue, carts and items per key, from a state and the products' prices."""
    prices = products.select(F.col("id").alias("priced_id"), "price")
    sold, plain = state.where("product_id is not null"), state.where("product_id is null")  # the latter would meet in one task
    priced = sold.join(prices, F.col("product_id") == F.col("priced_id"), "left").unionByName(plain, allowMissingColumns=True)
    filled = F.when(F.col("filled") > 0, F.col("quantity"))
    return (
        priced.groupBy(key)
        .agg(
            F.sum(F.col("price") * filled).alias("total_revenue"),
            F.sum("carts").alias("total_orders"),
            F.sum(filled).alias("total_items"),
            F.sum("lines").alias("lines"),
        )
        .where("lines > 0")
        .drop("lines")
    )


def _ticket() -> Column:
    return rounded_ratio(F.col("total_revenue"), F.col("total_orders"), 2)


def gold_from_states(
    spark: SparkSession,
    root: str,
    products: DataFrame,
    execution_date: ExecutionDate = None,
    created_at: CreatedAt = None,
    top: int = 10,
    stage: Callable[[DataFrame, str], DataFrame] = stage,
    for_writing: bool = False,
) -> dict[str, DataFrame]:
    """The gold tables as `build_gold` makes them from all cart lines, from the states up to a day.

    They are read from copies, so that they outlast a rerun or a merge of the states. With
    ``for_writing=True``, for tables that are written at once, states of one folder are read
    where they are, and the units per product, which three tables need, are added up once.
    """
    day = as_date(execution_date)
    if not _folders_until(spark, root, LOG, day):
        raise ValueError(f"there are no states up to {day} below {root}")

    def merged(item: tuple[str, str]) -> DataFrame:
        name, key = item
        folders = _folders_until(spark, root, name, day)
        rows = spark.read.parquet(*folders)
        if len(folders) > 1:
            return stage(_added_up(rows, [key, "product_id"]), name)
        return rows if for_writing else stage(rows, name)  # added up already

    dates, users = side_by_side(spark, merged, [(BY_DATE, "date"), (BY_USER, "user_id")])
    units = dates.groupBy(F.col("product_id").alias("products_productId")).agg(
        F.sum(F.when(F.col("filled") > 0, F.col("quantity"))).alias("quantity"), F.sum("lines").alias("lines")
    ).where("lines > 0")
    units = stage(units, "units_by_product") if for_writing else units
    daily = _totals(dates, products, "date").withColumns({"avg_ticket": _ticket(), "created_at": run_timestamp(created_at)})
    lifetime = _totals(users, products, "user_id").withColumns(
        {"avg_ticket": _ticket(), "customer_type": customer_type(F.col("total_orders")), "created_at": run_timestamp(created_at)}
    )
    frames = {
        "top10_products_revenue": rank_products(units, products, top),
        "sales_daily": daily,
        "product_performance": performance_of_products(units, products, created_at),
        "category_performance": performance_of_categories(units, products, created_at),
        "user_ltv": lifetime,
    }
    return {name: conform_to_schema(df, GOLD_TABLES[name].schema) for name, df in frames.items()}


def changed_carts(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What `update_gold_states` takes, from two full snapshots of cart lines: changed carts, and ids that are gone.

    Carts are compared by their lines and their numbers of copies. Lines without an
    id are no carts and left out.
    """
    counted = [
        _lines(df.where("id is not null")).groupBy(*LINE).agg(F.count(F.lit(1)).alias("copies")).withColumn("copies", F.col("copies") * sign)
        for df, sign in ((before, -1), (after, 1))
    ]
    differing = reduce(DataFrame.unionByName, counted).groupBy(*LINE).agg(F.sum("copies").alias("copies")).where("copies <> 0")
    ids = differing.select(F.col("cart_id").alias("id")).distinct()
    gone = ids.join(after.select("id"), "id", "left_anti")
    return after.join(ids, "id", "left_semi"), gone
