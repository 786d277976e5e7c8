"""Column names: quoting, lookup, collision checks and the technical prefixes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name prefixes of the columns that ingestion and change capture add.
INGESTION_PREFIX = "_airbyte"
CDC_PREFIX = "_ab_cdc"
DELETED_AT = "_ab_cdc_deleted_at"

# The partition columns of every zone, outermost first.
DATE_PARTITIONS = ("year", "month", "day")


def column(name: str) -> Column:
    """The column called exactly ``name``, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_technical(name: str) -> bool:
    return name.startswith((INGESTION_PREFIX, CDC_PREFIX))


def lookup(columns: Iterable[str], wanted: str) -> str | None:
    """Find ``wanted`` among ``columns``, exactly if possible, else ignoring case."""
    columns = list(columns)
    if wanted in columns:
        return wanted
    return next((c for c in columns if c.lower() == wanted.lower()), None)


def spare_name(columns: Iterable[str], base: str) -> str:
    """A column name starting with ``base`` that none of ``columns`` uses."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def require_unique(columns: Sequence[str], what: str) -> None:
    """Raise when two result columns would share a name (names ignore case in Spark)."""
    repeated = [c for c, n in Counter(c.lower() for c in columns).items() if n > 1]
    if repeated:
        raise ValueError(f"{what} would produce duplicate columns: {sorted(repeated)}")


def as_list(names: str | Iterable[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)
