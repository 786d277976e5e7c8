import itertools

import pytest
from pyspark.sql import functions as F

from stratalode.operators import (
    array_elements,
    array_lengths,
    arrays_cartesian,
    arrays_to_columns,
    explode_array,
    explode_unnest,
    flatten_all,
    flatten_structs,
    parse_json_column,
    unnest_structs,
    unwrap_document,
)

NESTED = "a struct<x: int, deep: struct<y: int, z: int>>, b int, `c.d` struct<`e.f`: int>, g array<struct<h: int>>"


def nested(spark):
    return spark.createDataFrame(
        [((1, (2, 3)), 4, (5,), [(6,)]), ((1, None), 4, None, None), (None, None, None, None)], NESTED
    )


def test_unnest_keeps_the_place_and_flatten_moves_plain_columns_forward(spark, rows):
    df = nested(spark)
    assert unnest_structs(df).columns == ["a_x", "a_deep_y", "a_deep_z", "b", "c.d_e.f", "g"]
    assert flatten_structs(df).columns == ["b", "g", "c.d_e.f", "a_x", "a_deep_y", "a_deep_z"]
    plain = [r[:5] for r in unnest_structs(df).collect()]
    assert plain == [(1, 2, 3, 4, 5), (1, None, None, 4, None), (None, None, None, None, None)]


@pytest.mark.parametrize("operator", [unnest_structs, flatten_structs])
def test_name_clashes_are_errors(spark, operator):
    df = spark.createDataFrame([((1,), 2)], "a struct<b: int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        operator(df)


def test_explode_keeps_rows_without_elements(spark, rows):
    df = spark.createDataFrame(
        [(1, [(10, 2), (11, 3)], "x"), (2, [], "y"), (3, None, "z")],
        "id int, products array<struct<productId: int, quantity: int>>, t string",
    )
    assert explode_array(df, "products").columns == ["id", "t", "products"]
    lines = explode_unnest(df, "products")
    assert lines.columns == ["id", "t", "products_productId", "products_quantity"]
    assert rows(lines) == [
        (1, "x", 10, 2), (1, "x", 11, 3), (2, "y", None, None), (3, "z", None, None),
    ]


def test_arrays_to_columns_pads_short_arrays(spark, rows):
    df = spark.createDataFrame(
        [([1, 2], 7, ["a"], None), ([3], 8, None, None), (None, 9, [], None)],
        "n array<int>, k int, s array<string>, empty array<int>",
    )
    wide = arrays_to_columns(df)
    assert wide.columns == ["k", "n_0", "n_1", "s_0"]
    assert rows(wide) == [(7, 1, 2, "a"), (8, 3, None, None), (9, None, None, None)]


def test_arrays_to_columns_without_arrays_is_distinct(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert arrays_to_columns(df).count() == 2


def test_arrays_of_any_length_become_columns_or_rows(spark):
    df = spark.createDataFrame([(1, list(range(6000))), (2, None)], "k int, a array<int>")
    wide = arrays_to_columns(df)
    assert len(wide.columns) == 6001
    assert wide.filter("k = 1").first()["a_5999"] == 5999
    long = array_elements(df, "a")
    assert long.columns == ["k", "position", "value"]
    assert long.filter("position = value").count() == 6000


def test_arrays_to_columns_refuses_excess_width_and_ignores_maps(spark):
    df = spark.createDataFrame([([1, 2, 3], {"k": [1]})], "a array<int>, m map<string, array<int>>")
    with pytest.raises(ValueError, match="allowed"):
        arrays_to_columns(df, max_columns=3)
    assert arrays_to_columns(df).columns == ["m", "a_0", "a_1", "a_2"]


def brute_cartesian(data, scalars, null_safe):
    """Explode each array by itself, then full outer join on the scalars, distinct."""

    def side(position):
        return {(*row[:scalars], e) for row in data for e in (row[position] or [None])}

    def equal(left, right):
        return null_safe or None not in left, left == right

    left, right = side(scalars), side(scalars + 1)
    out = set()
    for l, r in itertools.product(left, right):
        if all(equal(l[:scalars], r[:scalars])):
            out.add((*l, r[-1]))
    for l in left:
        if not any(all(equal(l[:scalars], r[:scalars])) for r in right):
            out.add((*l, None))
    for r in right:
        if not any(all(equal(r[:scalars], l[:scalars])) for l in left):
            out.add((*r[:scalars], None, r[-1]))
    return sorted(out, key=repr)


CARTESIAN = [
    (1, "a", [1, 2], ["x"]),
    (1, "a", [2, 3], ["y", "y"]),
    (2, "b", None, ["z"]),
    (3, "c", [], []),
    (None, "d", [5], ["n", "m"]),
    (None, "d", [5], ["n"]),
]
CARTESIAN_SCHEMA = "id int, k string, n array<int>, s array<string>"


@pytest.mark.parametrize("null_safe", [False, True])
def test_cartesian_by_values_against_brute_force(spark, rows, null_safe):
    df = spark.createDataFrame(CARTESIAN, CARTESIAN_SCHEMA)
    got = rows(arrays_cartesian(df, match="values", null_safe=null_safe))
    assert got == brute_cartesian(CARTESIAN, 2, null_safe)


def test_cartesian_by_row(spark, rows):
    df = spark.createDataFrame(CARTESIAN, CARTESIAN_SCHEMA)
    expected = {
        (i, k, x, y) for i, k, n, s in CARTESIAN for x in (n or [None]) for y in (s or [None])
    }
    assert rows(arrays_cartesian(df)) == sorted(expected, key=repr)


def test_cartesian_modes_agree_where_a_key_tells_rows_apart(spark, rows):
    keyed = [(i, *row[1:]) for i, row in enumerate(CARTESIAN)]
    df = spark.createDataFrame(keyed, CARTESIAN_SCHEMA)
    assert rows(arrays_cartesian(df)) == rows(arrays_cartesian(df, match="values"))


def test_a_known_key_saves_the_shuffles_and_changes_nothing(spark, rows, plan):
    keyed = [(i, *row[1:]) for i, row in enumerate(CARTESIAN)]
    df = spark.createDataFrame(keyed, CARTESIAN_SCHEMA)
    assert rows(arrays_cartesian(df, keyed=True)) == rows(arrays_cartesian(df))
    assert "Exchange" not in plan(arrays_cartesian(df, keyed=True))
    assert rows(flatten_all(df, keyed=True)) == rows(flatten_all(df))
    assert "Exchange" not in plan(flatten_all(df, keyed=True))


def test_a_key_is_not_trusted_after_its_rows_multiplied(spark, rows):
    """Two elements that differ only in their inner arrays give overlapping combinations."""
    df = spark.createDataFrame(
        [(1, [("a", [1, 2]), ("a", [2, 3])])], "id int, l array<struct<k: string, n: array<int>>>"
    )
    assert rows(flatten_all(df, cartesian=True, keyed=True)) == [(1, "a", 1), (1, "a", 2), (1, "a", 3)]


def test_cartesian_edge_cases(spark):
    plain = spark.range(2)
    assert arrays_cartesian(plain) is plain
    with pytest.raises(ValueError):
        arrays_cartesian(spark.createDataFrame([([1],)], "a array<int>"), match="values")
    with pytest.raises(ValueError):
        arrays_cartesian(spark.createDataFrame([([1],)], "a array<int>"), match="other")


def test_flatten_all_goes_through_every_level(spark, rows):
    df = spark.createDataFrame(
        [(1, [((1, [10, 11]),), ((2, [12]),)]), (2, None)],
        "id int, a array<struct<p: struct<q: int, r: array<int>>>>",
    )
    flat = flatten_all(df)
    assert flat.columns == [
        "id", "a_1_p_q", "a_0_p_q", "a_1_p_r_0", "a_0_p_r_0", "a_0_p_r_1",
    ]
    assert rows(flat.select("id", "a_0_p_q", "a_0_p_r_1", "a_1_p_r_0")) == [
        (1, 1, 11, 12), (2, None, None, None),
    ]
    crossed = flatten_all(df, cartesian=True)
    assert crossed.columns == ["id", "a_p_q", "a_p_r"]
    assert rows(crossed) == [(1, 1, 10), (1, 1, 11), (1, 2, 12), (2, None, None)]


def test_flatten_all_handles_arrays_of_arrays_and_plain_frames(spark):
    df = spark.createDataFrame([([[1, 2], [3]],)], "a array<array<int>>")
    assert flatten_all(df).columns == ["a_0_0", "a_0_1", "a_1_0"]
    twice = spark.createDataFrame([(1,), (1,)], "k int")
    assert flatten_all(twice).count() == 2


def test_unwrap_document(spark, rows):
    df = spark.createDataFrame(
        [("i", (1, "n"), 5, "r", 9)],
        "_id string, data struct<id: int, `full.name`: string>, _ab_cdc_cursor int, _airbyte_raw string, x int",
    )
    document = unwrap_document(df)
    assert document.columns == ["id", "full.name", "_ab_cdc_cursor", "_airbyte_raw"]
    assert rows(document) == [(1, "n", 5, "r")]
    plain = spark.range(1)
    assert unwrap_document(plain) is plain


JSON_TEXTS = [
    '{"k": 1, "nested": {"x.y": 1.5, "list": [1, 2]}, "mixed": 1, "OBJECT<q": true, "none": null}',
    '{"k": 2, "mixed": "text", "big": 12345678901234567890, "tags": [{"t": "a"}]}',
    None,
]


def test_inferred_json_type_equals_reading_the_text_as_json(spark, tmp_path):
    df = spark.createDataFrame([(t,) for t in JSON_TEXTS], "j string")
    path = str(tmp_path / "texts")
    df.filter("j is not null").write.text(path)
    by_reader = spark.read.json(path).schema
    parsed = parse_json_column(df, "j")

    def normal(schema):
        return sorted((f.name, f.dataType.simpleString()) for f in schema.fields)

    assert normal(parsed.schema["j"].dataType) == normal(by_reader)
    first = parsed.select(F.col("j.nested").getField("x.y"), "j.mixed", "j.k").collect()
    assert [tuple(r) for r in first] == [(1.5, "1", 1), (None, "text", 2), (None, None, None)]


def test_parse_json_with_schema_needs_no_job_and_survives_bad_text(spark):
    df = spark.createDataFrame([('{"k": 3}',), ("no json",)], "j string")
    parsed = parse_json_column(df, "j", "struct<k: int>")
    assert [r[0] for r in parsed.select("j.k").collect()] == [3, None]
    inferred = parse_json_column(df, "j")
    assert inferred.schema["j"].dataType.simpleString() == "struct<k:bigint>"


@pytest.mark.parametrize("text", [None, "1", "no json"])
def test_columns_without_json_objects_need_a_schema(spark, text):
    df = spark.createDataFrame([(text,)], "j string")
    with pytest.raises(ValueError, match="schema"):
        parse_json_column(df, "j")


def test_parse_json_infers_from_a_share_of_the_texts(spark):
    df = spark.range(2000).selectExpr("concat('{\"k\": ', id, '}') AS j").unionByName(spark.sql("SELECT 'no json' AS j"))
    parsed = parse_json_column(df, "j", sampling_ratio=0.05)
    assert parsed.where("j.k >= 0").count() == 2000
    with pytest.raises(ValueError, match="sampling_ratio"):
        parse_json_column(df, "j", sampling_ratio=0.0)


DEEP = "k int, a array<struct<x: int, b: array<struct<y: int, c: array<int>>>, s: struct<d: array<string>>>>, m array<array<int>>, o struct<e: array<int>>"


def deep(spark):
    return spark.createDataFrame(
        [
            (1, [(1, [(2, [3, 4]), (5, None)], (["p"],)), (6, [], None)], [[1], [2, 3, 4], None], ([9],)),
            (2, [None, (7, [(8, []), None, (9, [10, 11, 12])], ([],))], [], None),
            (3, None, None, (None,)), (3, None, None, (None,)), (4, [], [[]], ([],)),
        ],
        DEEP,
    )


def in_rounds(df, keyed=False):
    """The same, one level of arrays after another."""
    while any(f.dataType.typeName() in ("array", "struct") for f in df.schema.fields):
        df = arrays_to_columns(flatten_structs(df), keyed=keyed)
    return df


@pytest.mark.parametrize("keyed", [False, True])
def test_flattening_at_once_equals_flattening_in_rounds(spark, rows, keyed):
    for df in (deep(spark), deep(spark).limit(0), nested(spark), deep(spark).select("k", "m"), deep(spark).select("o")):
        at_once, want = flatten_all(df, keyed=keyed), in_rounds(df, keyed)
        assert at_once.columns == want.columns
        assert at_once.dtypes == want.dtypes
        assert rows(at_once) == rows(want)


def test_lengths_of_all_levels(spark):
    longest = array_lengths(deep(spark))
    assert longest[1,] == 2 and longest[2,] == 3 and longest[3, 0] == 1
    assert (longest[1, 0, 1], longest[1, 1, 1]) == (2, 3)
    assert (longest[1, 0, 1, 0, 1], longest[1, 1, 1, 2, 1], longest[1, 0, 2, 0]) == (2, 3, 1)
    assert (longest[2, 0], longest[2, 1]) == (1, 3)
    assert array_lengths(spark.range(1)) == {}


def test_any_depth_takes_one_aggregation(spark):
    df = deep(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        store = spark._jsparkSession.sharedState().statusStore()
        before = store.executionsCount()
        flat = flatten_all(df)
        assert store.executionsCount() - before == 1
        assert len(flat.columns) > 10
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_names_that_meet_and_too_many_columns_are_errors(spark):
    df = spark.createDataFrame([([(1,), (2,)], 3)], "a array<struct<b: int>>, a_1_b int")
    with pytest.raises(ValueError, match="a_1_b"):
        flatten_all(df)
    with pytest.raises(ValueError, match="columns needed"):
        flatten_all(df.drop("a_1_b"), max_columns=1)
