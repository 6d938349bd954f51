from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.functions.schema import (
    coerce_types,
    common_type,
    drop_columns,
    priority_order,
    rename_columns,
    resolve,
    with_provenance,
)
from variantry.functions.text import double_text_sql, tokens
from variantry.operators.cohort import union_aligned


def test_coercion(spark):
    cells = ["7", "", ".", "NA", None, "4.7", "-4.7", "zz", "True", "False", "nan", "1e3", " 5 ", "2d", "9007199254740993"]
    df = spark.createDataFrame([(i, c, c, c, c) for i, c in enumerate(cells)], "id int, i string, f string, b string, s string")
    rows = coerce_types(df, {"i": "int64", "f": "float64", "b": "bool", "s": "string", "x": "int64"}).orderBy("id").collect()
    assert [r.i for r in rows] == [7, 0, 0, 0, 0, 4, -4, 0, 0, 0, 0, 1000, 5, 0, 9007199254740993]
    assert [r.f for r in rows] == [7, None, None, None, None, 4.7, -4.7, None, None, None, None, 1000, 5, None, 9007199254740992]
    assert [r.b for r in rows] == [False] * 8 + [True, False] + [False] * 5
    assert [r.s for r in rows] == cells


def test_doubles_read_as_in_python(spark):
    values = [0.0, 1.0, -1.5, 0.1, 1e-3, 1.5e-4, -2e-4, 1e-4, 1e-5, 1.25e-5, 1e-10, 2.5e-300, 9999999.0, 1e7, 12345678.0,
              12345678.25, 1.5e10, -3e15, 1e16, 1.25e16, 1e22, 1e100, 123456789012345.6, float("inf"), float("-inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = [r.t for r in df.select("i", F.expr(double_text_sql("v")).alias("t")).orderBy("i").collect()]
    assert found == [repr(v) for v in values]


def test_tokens(spark):
    cells = ["A; B ,C|D&E", "A;;B", " ", ".", "", None, ".;A"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    found = [r.t for r in df.select("i", tokens(F.col("c")).alias("t")).orderBy("i").collect()]
    assert found == [["A", "B", "C", "D", "E"], ["A", "B"], [], [], [], None, [".", "A"]]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`ANN['HGVS.c']` int, `cDNA.pos / x` int, POS int")
    assert rename_columns(df, {"POS": "pos2", "none": "x"}).columns == ["ANN['HGVS.c']", "cDNA.pos / x", "pos2"]
    assert drop_columns(df, ["ANN['HGVS.c']", "pos", "absent"]).columns == ["cDNA.pos / x", "POS"]
    assert priority_order(df, ["POS", "absent"]).columns == ["POS", "ANN['HGVS.c']", "cDNA.pos / x"]
    assert resolve(df, "pos") == "POS" and resolve(df, "POS") == "POS" and resolve(df, "x") is None
    assert with_provenance(df, "f1", "f1.rest.tsv").first()[:2] == ("f1", "f1.rest.tsv")


def test_union_widens_types(spark):
    a = spark.createDataFrame([(1, "x", 5)], "a int, b string, c long")
    b = spark.createDataFrame([(2.5, 7, "q")], "a double, b long, d string")
    rows = union_aligned([a, b]).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1.0, "x", 5, None), (2.5, "7", None, "q")]
    assert common_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert common_type([T.NullType(), T.BooleanType()]) == T.BooleanType()
    assert common_type([T.BooleanType(), T.LongType()]) == T.StringType()
