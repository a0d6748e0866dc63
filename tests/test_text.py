from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions import vector as V


def test_tokens_case_and_accents(spark):
    df = spark.createDataFrame([("The the THE café\tx1-y_2",)], "t string")
    assert df.select(T.tokens("t")).first()[0] == ["The", "the", "THE", "caf", "x1", "y", "2"]


def test_query_tokens_dedupe(spark):
    df = spark.createDataFrame([("a b a",)], "t string")
    assert sorted(df.select(T.query_tokens("t")).first()[0]) == ["a", "b"]


def test_quantize_examples(spark):
    vals = [-1.0, 0.0, 15.0, 29.99, 30.0, 99.0]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = [r[0] for r in df.select(T.quantize("s")).collect()]
    assert got == [0, 0, 127, 254, 255, 255]


def test_dequantize(spark):
    df = spark.createDataFrame([(255,), (0,)], "q int")
    got = [r[0] for r in df.select(T.dequantize("q")).collect()]
    assert got == [30.0, 0.0]


def test_idf_negative_for_common_terms(spark):
    df = spark.createDataFrame([(10, 9), (10, 1)], "n bigint, d bigint")
    a, b = [r[0] for r in df.select(T.idf("n", "d")).collect()]
    assert a < 0 < b


def test_cosine_zero_vector_is_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 1.0], [2.0, 2.0])],
                               "a array<float>, b array<float>")
    got = [r[0] for r in df.select(V.cosine("a", "b")).collect()]
    assert got[0] == 0.0 and abs(got[1] - 1.0) < 1e-12


def test_dot(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "a array<float>, b array<float>")
    assert df.select(V.dot("a", "b")).first()[0] == 32.0
    assert df.select(F.round(V.norm("a") ** 2, 9)).first()[0] == 14.0
