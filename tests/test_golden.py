"""Golden literals: expected values stated beside the documented function
examples, evaluated with the same Spark expressions the library uses."""

import pytest

# Fixed values: (Spark SQL expression, expected Python value), as stated in the documented examples.
GOLDEN = [
    ("array(1, 2, 3)", [1, 2, 3]),
    ("flatten(array(array(1,2), array(3,4)))", [1, 2, 3, 4]),
    ("array_distinct(array(1,1,2,3))", [1, 2, 3]),
    ("array_sort(array(3,1,2))", [1, 2, 3]),
    ("array_join(array('a','b','c'), ',')", "a,b,c"),
    ("transform(array(1,2,3), x -> x * 10)", [10, 20, 30]),
    ("filter(array(1,2,3,4), x -> x > 2)", [3, 4]),
    ("aggregate(array(1,2,3), 0, (acc, x) -> acc + x)", 6),
    ("size(arrays_zip(array(1,2), array('a','b')))", 2),
]


@pytest.mark.parametrize("expr,expected", GOLDEN)
def test_golden_literal(spark, expr, expected):
    v = spark.sql(f"SELECT {expr} AS v").first().v
    assert (list(v) if isinstance(v, list) else v) == expected


def test_explode_forms(spark, sf):
    """Words of the part names: every generator gives one row a word, with its place where it has one."""
    from pyspark.sql import functions as F

    parts = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.split("p_name", " ").alias("w"))
    n_words = parts.agg(F.sum(F.size("w"))).first()[0]
    assert parts.select(F.explode("w")).count() == n_words
    placed = parts.select("w", F.posexplode("w").alias("at", "word"))
    assert placed.filter(F.get("w", F.col("at")) != F.col("word")).count() == 0
    by_word = F.map_from_arrays(F.array_distinct("w"), F.transform(F.array_distinct("w"), F.length))
    assert parts.select(F.explode(by_word).alias("word", "letters")).filter("length(word) <> letters").count() == 0
    rows = parts.select("p_partkey", F.inline(F.transform("w", lambda x, i: F.struct(i.alias("at"), x.alias("word")))))
    assert rows.groupBy("p_partkey").agg(F.max("at").alias("m")).count() == parts.count()
    nothing = F.filter("w", lambda x: x == "no such word")
    assert parts.select(F.explode_outer(nothing)).count() == parts.count() and parts.select(F.explode(nothing)).count() == 0


def test_zorder_index_of_3_5(spark):
    """Fixed value: the Z-index of (x=3, y=5) is 100111."""
    from pyspark.sql import functions as F

    from driftwood.operators.layout import zorder_value

    df = spark.createDataFrame([(3, 5)], "x long, y long")
    assert df.select(zorder_value([F.col("x"), F.col("y")], 3).alias("z")).first().z == 0b100111
