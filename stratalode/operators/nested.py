"""Structs, arrays and JSON text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalode.functions.names import column, is_technical, require_unique, spare_name
from stratalode.operators.dedup import distinct_rows

Leaf = tuple[str, Column]


def _in_place(name: str, value: Column, dtype: T.DataType) -> Iterator[Leaf]:
    """The leaves of one column, where the column stood."""
    if not isinstance(dtype, T.StructType):
        yield name, value
        return
    for child in dtype.fields:
        yield from _in_place(f"{name}_{child.name}", value.getField(child.name), child.dataType)


def _scalars_first(fields: list[tuple[str, Column, T.DataType]]) -> Iterator[Leaf]:
    """Plain fields first, then each struct's own fields, the last struct foremost."""
    for name, value, dtype in fields:
        if not isinstance(dtype, T.StructType):
            yield name, value
    for name, value, dtype in reversed(fields):
        if isinstance(dtype, T.StructType):
            yield from _scalars_first(
                [(f"{name}_{c.name}", value.getField(c.name), c.dataType) for c in dtype.fields]
            )


def _project(df: DataFrame, leaves: Iterator[Leaf], what: str) -> DataFrame:
    leaves = list(leaves)
    require_unique([name for name, _ in leaves], what)
    return df.select(*[value.alias(name) for name, value in leaves])


def unnest_structs(df: DataFrame) -> DataFrame:
    """Expand structs, however deep, into ``parent_child`` columns, in place.

    Arrays stay as they are, also arrays of structs. The leaves are worked out
    on the schema, so the result is one projection and only the leaves a later
    step uses are read from the file.
    """
    leaves = (leaf for f in df.schema.fields for leaf in _in_place(f.name, column(f.name), f.dataType))
    return _project(df, leaves, "unnest_structs")


def flatten_structs(df: DataFrame) -> DataFrame:
    """Expand structs like :func:`unnest_structs`, with plain columns moved to the front."""
    fields = [(f.name, column(f.name), f.dataType) for f in df.schema.fields]
    return _project(df, _scalars_first(fields), "flatten_structs")


def explode_array(df: DataFrame, name: str) -> DataFrame:
    """One row per element, the other columns repeated and the element last.

    A NULL or empty array gives one row with a NULL element.
    """
    others = [column(c) for c in df.columns if c != name]
    return df.select(*others, F.explode_outer(column(name)).alias(name))


def explode_unnest(df: DataFrame, name: str) -> DataFrame:
    """Explode an array of structs and spread the element over columns."""
    return unnest_structs(explode_array(df, name))


def _array_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def arrays_to_columns(
    df: DataFrame, max_columns: int | None = None, keyed: bool = False
) -> DataFrame:
    """Turn every array into columns ``name_0 … name_{n-1}``, n being its longest row.

    The lengths of all arrays come from one aggregation that returns a single
    row. Shorter arrays are padded with NULL. With ``max_columns``, more result
    columns are an error, as no element may be dropped to stay below it.
    :func:`array_elements` is the long form for arrays of many elements.

    A frame without arrays comes back with duplicate rows removed; ``keyed``
    says that it has none, which saves the shuffle.
    """
    arrays = _array_columns(df)
    if not arrays:
        return df if keyed else distinct_rows(df)
    longest = df.agg(
        *[F.max(F.array_size(column(a))).alias(str(i)) for i, a in enumerate(arrays)]
    ).first()
    widths = {a: longest[i] or 0 for i, a in enumerate(arrays)}
    kept = [c for c in df.columns if c not in widths]
    wide = [(f"{a}_{i}", F.get(column(a), i)) for a in arrays for i in range(widths[a])]
    if max_columns is not None and len(kept) + len(wide) > max_columns:
        raise ValueError(
            f"{len(kept) + len(wide)} columns needed, {max_columns} allowed; array lengths: {widths}"
        )
    require_unique([*kept, *[name for name, _ in wide]], "arrays_to_columns")
    return df.select(*map(column, kept), *[value.alias(name) for name, value in wide])


def array_elements(df: DataFrame, name: str) -> DataFrame:
    """One row per element of an array, with its ``position`` from 0 and its ``value``.

    Rows whose array is empty or NULL have no element and no row.
    """
    kept = [column(c) for c in df.columns if c != name]
    return df.select(*kept, F.posexplode(column(name)).alias("position", "value"))


def arrays_cartesian(
    df: DataFrame, match: str = "row", null_safe: bool = False, keyed: bool = False
) -> DataFrame:
    """Every combination of the elements of a row's arrays, without duplicate rows.

    ``match="row"`` combines the arrays of one and the same row: a chain of
    narrow explodes, so the work per row depends on that row alone. ``keyed``
    says that the columns that are no arrays hold a key: then only the elements
    of each array need to be made distinct, and nothing is shuffled.

    ``match="values"`` combines the arrays of all rows whose other columns are
    equal. It equals ``"row"`` whenever the other columns hold a key. Each array
    is exploded by itself and made distinct before it is joined to the others,
    so copies of a row, however many, meet as one. NULL never equals NULL here:
    a row with a NULL among its other columns stays unmatched and appears once
    per array, the other arrays NULL. ``null_safe=True`` treats NULLs as equal.
    """
    arrays = _array_columns(df)
    if not arrays:
        return df
    scalars = [c for c in df.columns if c not in arrays]
    if match == "row":
        thinned = df.withColumns({a: F.array_distinct(column(a)) for a in arrays})
        if keyed:
            return reduce(explode_array, arrays, thinned)
        return distinct_rows(reduce(explode_array, arrays, thinned))
    if match != "values":
        raise ValueError(f"match must be 'row' or 'values', not {match!r}")
    if not scalars:
        raise ValueError("match='values' needs a column that is not an array")
    sides = [
        df.select(*map(column, scalars), F.explode_outer(column(a)).alias(a)) for a in arrays
    ]
    if null_safe:
        return reduce(
            lambda left, right: _join_null_safe(left, right, scalars), map(distinct_rows, sides)
        )
    # Every row is on every side, so a full outer join is an inner one plus the rows
    # with NULLs. Unlike the outer join, the inner one can be split at a hot value.
    whole = reduce(and_, [column(c).isNotNull() for c in scalars])
    matched = reduce(
        lambda left, right: left.join(right, on=scalars),
        [distinct_rows(side.filter(whole)) for side in sides],
    )
    unmatched = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [side.filter(~whole) for side in sides],
    )
    order = [column(c) for c in [*scalars, *arrays]]
    return matched.select(*order).union(distinct_rows(unmatched.select(*order)))


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Join where NULL equals NULL. Both sides come from the same rows, so inner is whole."""
    renamed = {c: spare_name([*left.columns, *right.columns], f"{c}_right") for c in on}
    right = right.withColumnsRenamed(renamed)
    same = reduce(and_, [column(c).eqNullSafe(column(r)) for c, r in renamed.items()])
    return left.join(right, same).drop(*renamed.values())


def _holds_array(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_array(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.ArrayType)


def _lengths(value: Column, dtype: T.DataType, path: Column) -> Iterator[Column]:
    """Arrays of (path, length) for every array within a value, those inside of elements included.

    A path is made of the places of fields and elements, from the top.
    """
    if isinstance(dtype, T.StructType):
        for i, child in enumerate(dtype.fields):
            if _holds_array(child.dataType):
                yield from _lengths(value.getField(child.name), child.dataType, F.array_append(path, F.lit(i)))
    elif isinstance(dtype, T.ArrayType):
        yield F.array(F.struct(path.alias("path"), F.array_size(value).alias("length")))
        if _holds_array(dtype.elementType):

            def of_element(element: Column, i: Column) -> Column:
                return F.concat(*_lengths(element, dtype.elementType, F.array_append(path, i)))

            yield F.coalesce(F.flatten(F.transform(value, of_element)), F.array().cast(_LENGTHS))


_LENGTHS = "array<struct<path: array<int>, length: int>>"


def array_lengths(df: DataFrame) -> dict[tuple[int, ...], int]:
    """The longest length of every array of a frame, however deep, by its path.

    One aggregation over the rows answers all levels: each row lists the lengths of
    its arrays, and tasks keep the longest per path before anything is shuffled. An
    array inside of an array has a length for each element it can stand in, so there
    are as many results as :func:`flatten_all` has arrays to turn into columns.
    Arrays that no row holds have length 0 or, inside of elements, no entry.
    """
    start = F.array().cast("array<int>")
    found = [
        each
        for i, f in enumerate(df.schema.fields)
        if _holds_array(f.dataType)
        for each in _lengths(column(f.name), f.dataType, F.array_append(start, F.lit(i)))
    ]
    if not found:
        return {}
    listed = df.select(F.inline(F.concat(*found))).where("length is not null")
    return {tuple(r["path"]): r["length"] for r in listed.groupBy("path").agg(F.max("length").alias("length")).collect()}


@dataclass(frozen=True)
class _Part:
    """A column of a frame that is being flattened, and where its value comes from."""

    name: str
    value: Column
    dtype: T.DataType
    path: tuple[int, ...]


def _without_structs(parts: list[_Part]) -> Iterator[_Part]:
    """The order of :func:`flatten_structs`."""
    for part in parts:
        if not isinstance(part.dtype, T.StructType):
            yield part
    for part in reversed(parts):
        if isinstance(part.dtype, T.StructType):
            yield from _without_structs([
                _Part(f"{part.name}_{c.name}", part.value.getField(c.name), c.dataType, (*part.path, i))
                for i, c in enumerate(part.dtype.fields)
            ])


def _arrays_side_by_side(df: DataFrame, max_columns: int | None, keyed: bool) -> DataFrame:
    """All rounds of :func:`flatten_structs` and :func:`arrays_to_columns` as one projection."""
    longest = array_lengths(df)
    parts = [_Part(f.name, column(f.name), f.dataType, (i,)) for i, f in enumerate(df.schema.fields)]
    distinct = False
    while any(isinstance(p.dtype, (T.ArrayType, T.StructType)) for p in parts):
        parts = list(_without_structs(parts))
        require_unique([p.name for p in parts], "flatten_structs")
        arrays = [p for p in parts if isinstance(p.dtype, T.ArrayType)]
        distinct = not arrays and not keyed
        kept = [p for p in parts if not isinstance(p.dtype, T.ArrayType)]
        wide = [
            _Part(f"{a.name}_{i}", F.get(a.value, F.lit(i)), a.dtype.elementType, (*a.path, i))
            for a in arrays
            for i in range(longest.get(a.path, 0))
        ]
        parts = kept + wide
        if max_columns is not None and arrays and len(parts) > max_columns:
            lengths = {a.name: longest.get(a.path, 0) for a in arrays}
            raise ValueError(f"{len(parts)} columns needed, {max_columns} allowed; array lengths: {lengths}")
        require_unique([p.name for p in parts], "arrays_to_columns")
    flat = df.select(*[p.value.alias(p.name) for p in parts])
    return distinct_rows(flat) if distinct else flat


def flatten_all(
    df: DataFrame,
    cartesian: bool = False,
    match: str = "row",
    null_safe: bool = False,
    max_columns: int | None = None,
    keyed: bool = False,
) -> DataFrame:
    """Repeat struct expansion and array removal until only plain columns are left.

    Arrays become columns, or combinations of rows with ``cartesian=True``.
    Columns for arrays of all levels come from one aggregation, see
    :func:`array_lengths`, and one projection. Combinations take as many rounds as
    the schema is deep. ``keyed`` says that the columns without arrays hold a key,
    which saves shuffles.
    """
    if not cartesian:
        return _arrays_side_by_side(df, max_columns, keyed)
    nested = (T.ArrayType, T.StructType)
    while any(isinstance(f.dataType, nested) for f in df.schema.fields):
        df = arrays_cartesian(flatten_structs(df), match=match, null_safe=null_safe, keyed=keyed)
        keyed = False  # the key's rows have multiplied
    return df


def unwrap_document(df: DataFrame, name: str = "data") -> DataFrame:
    """Replace a document envelope by the document's fields and the control columns.

    All other columns of the envelope are dropped. A frame without the document
    column is returned as it is.
    """
    if name not in df.columns:
        return df
    document = [(f.name, column(name).getField(f.name)) for f in df.schema[name].dataType.fields]
    controls = [(c, column(c)) for c in df.columns if is_technical(c)]
    return _project(df, iter([*document, *controls]), "unwrap_document")


def _inferred_json_type(df: DataFrame, name: str) -> str:
    """The type that fits every JSON text in a column, as DDL.

    A distributed aggregate merges the types of all rows and returns one string.
    As when reading JSON files, fractions become doubles, and fields that are
    always null or of mixed type become strings. Text that is no JSON is ignored.
    """
    found = df.select(F.schema_of_variant_agg(F.try_parse_json(column(name)))).first()[0]
    if not found.startswith(("OBJECT<", "ARRAY<")):
        raise ValueError(f"column {name} holds no JSON objects or arrays alone; pass their schema")
    pieces = re.split(r"(`(?:[^`]|``)*`)", found)
    for i in range(0, len(pieces), 2):  # odd pieces are quoted field names
        piece = pieces[i].replace("OBJECT<", "STRUCT<")
        piece = re.sub(r"\bDECIMAL\(\d+,[1-9]\d*\)", "DOUBLE", piece)
        pieces[i] = re.sub(r"\b(VOID|VARIANT)\b(?!:)", "STRING", piece)
    return "".join(pieces)


def parse_json_column(
    df: DataFrame, name: str, schema: T.DataType | str | None = None, sampling_ratio: float = 1.0
) -> DataFrame:
    """Parse a column of JSON text in place.

    Without ``schema`` the type is inferred, which reads the whole column once
    more; pass one for large inputs. ``sampling_ratio`` infers it from that share of
    the texts only, chosen by their hashes: quicker, but fields that are in none of
    them are left out, and numbers may not fit. All rows are parsed either way.
    """
    if not 0 < sampling_ratio <= 1:
        raise ValueError(f"sampling_ratio must be above 0 and at most 1, not {sampling_ratio}")
    if schema is None:
        texts = df.select(column(name))
        if sampling_ratio < 1:
            texts = texts.where(F.pmod(F.xxhash64(column(name)), F.lit(1 << 30)) < int(sampling_ratio * (1 << 30)))
        schema = _inferred_json_type(texts, name)
    return df.withColumn(name, F.from_json(column(name), schema))
