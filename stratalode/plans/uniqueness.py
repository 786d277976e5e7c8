"""Keys and required columns of a table that grows by days, checked without reading it anew.

A day leaves three folders beside each other: its keys with their counts, dealt
into buckets; a Bloom filter of its keys; and the keys that break a rule, those that
other days hold and those with NULLs or repeated on the day itself. A new day
meets the filters of all other days first. Only what they may hold is looked up
among the stored keys, in the buckets concerned, and decided there exactly.

The filters are made of blocks of 512 bits and a key touches one of them, so a
filter is a table of blocks that is joined on their numbers: it may be as large as
it has to be and is never collected.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalode.functions.names import as_list, column
from stratalode.plans.contract import broken_rules
from stratalode.sinks.stage import staging
from stratalode.sources.dated import ExecutionDate, as_date, date_folder, day_folders, day_is_complete, table_root

_WORDS = [f"w{i}" for i in range(8)]
#: The bucket of keys that hold a NULL. They cannot be repeated, so none is looked up there.
_NO_KEY = -1


def _bit(i: int) -> Column:
    """The bit of a key in word ``i`` of its block."""
    place = F.pmod(F.xxhash64(F.lit(i), "hash"), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _block(blocks: Column) -> Column:
    return F.col("hash").bitwiseAND(blocks - 1)


def _finished(spark: SparkSession, root: str) -> dict[str, str]:
    """The finished days below a root, as text, with their folders."""
    return {day.isoformat(): path for day, path in day_folders(spark, root) if day_is_complete(spark, path)}


def _read_days(spark: SparkSession, root: str, days: Iterable[str]) -> DataFrame:
    found = spark.read.option("basePath", root).parquet(*[f"{root}/{date_folder(d)}" for d in days])
    return found.withColumn("on_day", F.make_date("year", "month", "day").cast("string"))


def _hashed(counted: DataFrame, ks: list[str]) -> DataFrame:
    """Keys with their hash, which is not stored: it does not compress and is longer than many keys."""
    return counted.withColumn("hash", F.xxhash64(*ks))


def _count_keys(rows: DataFrame, keys: list[str], checked: list[str], buckets: int) -> DataFrame:
    """One row per key: k0, k1, …, how many rows hold it, NULLs of the checked columns, and bucket."""
    named = [column(k).alias(f"k{i}") for i, k in enumerate(keys)]
    counted = rows.groupBy(*named).agg(
        F.count("*").alias("rows"), *[F.count_if(column(c).isNull()).alias(f"n{i}") for i, c in enumerate(checked)]
    )
    ks = [f"k{i}" for i in range(len(keys))]
    whole = reduce(and_, [F.col(k).isNotNull() for k in ks])
    # Bits that choose neither the block of a filter nor a place in it.
    bucket = F.when(whole, F.pmod(F.xxhash64(F.lit(-1), F.xxhash64(*ks)), F.lit(buckets))).otherwise(_NO_KEY)
    return counted.withColumn("bucket", bucket.cast("int"))


def _write_filter(stored: DataFrame, path: str, bits_per_key: int, ks: list[str]) -> None:
    keys = _hashed(stored.where(F.col("bucket") != _NO_KEY), ks).select("hash")
    needed = max(1, -(-keys.count() * bits_per_key // 512))
    blocks = 1 << (needed - 1).bit_length()
    held = keys.groupBy(_block(F.lit(blocks)).alias("block")).agg(*[F.bit_or(_bit(i)).alias(w) for i, w in enumerate(_WORDS)])
    held.withColumn("blocks", F.lit(blocks).cast("bigint")).write.mode("overwrite").parquet(path)


def _candidates(stored: DataFrame, filters: DataFrame, ks: list[str]) -> DataFrame:
    """Keys of a day and their ``own`` rows with each other day whose filter may hold them, as ``on_day``.

    A key is sent once per size of filters, which is a power of two, and meets the
    blocks of all days of that size with the same number.
    """
    keys = _hashed(stored.where(F.col("bucket") != _NO_KEY), ks).withColumnRenamed("rows", "own")
    sizes = F.array(*[F.lit(r[0]) for r in filters.select("blocks").distinct().collect()])
    asked = keys.withColumn("blocks", F.explode(sizes)).withColumn("block", _block(F.col("blocks")))

    asked = asked.select(*ks, "own", "bucket", "hash", "blocks", "block")
    may_hold = reduce(and_, [F.col(w).bitwiseAND(_bit(i)) != 0 for i, w in enumerate(_WORDS)])
    return asked.join(filters, ["blocks", "block"]).where(may_hold).select(*ks, "own", "bucket", "on_day")


def constraint_violations_incremental(
    rows: DataFrame,
    root: str,
    table: str,
    execution_date: ExecutionDate,
    keys: str | Iterable[str],
    required: str | Iterable[str] | None = None,
    buckets: int = 64,
    bits_per_key: int = 16,
) -> DataFrame:
    """Check a day's ``rows`` against themselves and all other days; findings of all days so far.

    Returns what :func:`constraint_violations` returns for the rows of all checked
    days together. State is kept in ``<table>_keys``, ``<table>_filters`` and
    ``<table>_broken`` below ``root``. Of other days, filters are read, and stored
    keys only in those buckets that a filter says may hold a key of the day:
    about one key in a thousand is looked up in vain for each other day with 16 bits
    a key, and with as many ``buckets`` as a day has files few are opened.

    Days may come in any order and a day can be repeated with the same rows. A day
    repeated with other rows replaces its own findings; days checked in between have
    counted the former rows and need to be repeated after it. Only finished days
    count; an empty day has no keys. Key and required columns must keep their types.
    """
    spark, keys, day = rows.sparkSession, as_list(keys), as_date(execution_date).isoformat()
    checked = list(dict.fromkeys([*keys, *as_list(required)]))
    ks, ns = [f"k{i}" for i in range(len(keys))], [f"n{i}" for i in range(len(checked))]
    homes = {part: table_root(root, f"{table}_{part}") for part in ("keys", "filters", "broken")}
    own = {part: f"{home}/{date_folder(day)}" for part, home in homes.items()}

    counted = _count_keys(rows, keys, checked, buckets)
    dealt = counted.hint("rebalance", "bucket").sortWithinPartitions("bucket").write.mode("overwrite")
    dealt.option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(own["keys"])
    # Declared types, so that a day without keys, which has no files, can be read as well.
    stored = spark.read.schema(counted.schema).parquet(own["keys"])
    _write_filter(stored, own["filters"], bits_per_key, ks)

    others = [d for d in _finished(spark, homes["filters"]) if d != day]
    with staging(spark) as keep:
        nulls = reduce(or_, [F.col(n) > 0 for n in ns])
        broken = stored.where((F.col("rows") > 1) | nulls).select(*ks, F.col("rows").alias("total"), *ns)
        held = None
        if others:
            maybe = keep(_candidates(stored, _read_days(spark, homes["filters"], others), ks), "candidates")
            held = _looked_up(spark, maybe, homes["keys"], counted, ks)
        if held is not None:  # a row of its own without the key's NULLs, which `broken` counts
            broken = broken.unionByName(held.select(*ks, "total", *[F.lit(0).cast("bigint").alias(n) for n in ns]))
        broken.write.mode("overwrite").parquet(own["broken"])
    return stored_violations(spark, root, table, keys, required)


def _looked_up(spark: SparkSession, maybe: DataFrame, home: str, counted: DataFrame, ks: list[str]) -> DataFrame | None:
    """The candidates that other days hold, with the rows of all days; only their days' and buckets' folders are read."""
    places = maybe.select("on_day", "bucket").distinct().collect()  # at most days times buckets
    if not places:
        return None
    paths = [f"{home}/{date_folder(p['on_day'])}/bucket={p['bucket']}" for p in places]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counted.schema if f.name in (*ks, "rows"))
    schema = f"{fields}, bucket int, year int, month int, day int"
    held = spark.read.schema(schema).option("basePath", home).parquet(*paths)
    held = held.withColumn("on_day", F.make_date("year", "month", "day").cast("string"))
    found = held.drop("bucket").join(maybe.drop("bucket"), [*ks, "on_day"])  # a day holds a key once, and asks for it once
    return found.groupBy(*ks).agg((F.sum("rows") + F.max("own")).alias("total"))


def stored_violations(
    spark: SparkSession, root: str, table: str, keys: str | Iterable[str], required: str | Iterable[str] | None = None
) -> DataFrame:
    """The findings of all days checked so far, from the stored broken keys alone.

    Each day has stored how many rows hold a key in all days known then, so the
    largest number is the one of all days; NULLs are counted once per day and added up.
    """
    keys = as_list(keys)
    checked = list(dict.fromkeys([*keys, *as_list(required)]))
    home = table_root(root, f"{table}_broken")
    ks, ns = [f"k{i}" for i in range(len(keys))], [f"n{i}" for i in range(len(checked))]
    broken = spark.read.parquet(*_finished(spark, home).values())
    per_key = broken.groupBy(*ks).agg(F.max("total").alias("rows"), *[F.sum(n).alias(n) for n in ns])
    return broken_rules(per_key, dict(zip(keys, ks, strict=True)), "rows", dict(zip(checked, ns, strict=True)))
