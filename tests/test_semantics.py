"""Null, ordering, rounding and overwrite rules on tiny frames; expected values by hand."""

from decimal import Decimal

from pyspark.sql import functions as F

from arrears.functions import bands as B
from arrears.functions import scalars as S
from arrears.functions import semantics as M
from arrears.operators import cleaning as C
from arrears.operators import joins as J
from arrears.operators import windows as W


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(spark, schema, *values):
    return spark.createDataFrame([values], schema)


def test_missing_keys_do_not_join_by_default(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, r string")
    assert rows(J.inner(left, right, ["k"]), "k") == [(1, "a", "x")]
    joined = {r["l"]: r["r"] for r in J.left_join(left, right, ["k"]).collect()}
    assert joined == {"a": "x", "b": None}
    matched = {(r["l"], r["r"]) for r in J.full_matching_nulls(left, right, "k").collect()}
    assert matched == {("a", "x"), ("b", "y")}


def test_anti_and_semi(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert {r["k"] for r in J.anti(left, right, ["k"]).collect()} == {1, None}
    assert [r["k"] for r in J.semi(left, right, ["k"]).collect()] == [2]


def test_right_join_keeps_every_right_row(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, r string")
    found = {(r["k"], r["l"], r["r"]) for r in J.right(left, right, ["k"]).collect()}
    assert found == {(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (None, None, "z")}


def test_groups_without_key_are_dropped_and_empty_sums_are_zero(spark):
    df = spark.createDataFrame([("a", None), (None, 5)], "k string, v int")
    assert rows(M.present(df, "k").groupBy("k").agg(M.sum0("v").alias("s")), "k") == [("a", 0)]


def test_division_by_zero_is_missing(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (3, 2)], "a int, b int")
    assert [r[0] for r in df.select(M.ratio("a", "b")).collect()] == [None, None, 1.5]


def test_casts_skip_bad_text(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,)], "k string")
    assert rows(C.typed_key(df, "k"), "k") == [(7,)]


def test_inequality_is_true_for_missing(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "x string")
    assert {r["x"] for r in df.where(M.differs("x", "A")).collect()} == {"B", None}


def test_missing_sorts_last_both_ways(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r["x"] for r in df.orderBy(M.ascending("x")).collect()] == [1, 2, None]
    assert [r["x"] for r in df.orderBy(M.descending("x")).collect()] == [2, 1, None]


def test_rounding_goes_to_even(spark):
    df = spark.createDataFrame([(0.5, 0), (1.5, 0), (2.5, 0), (0.125, 2), (0.375, 2)], "x double, d int")
    whole = [r[0] for r in df.where("d = 0").select(M.round_even("x", 0)).collect()]
    two = [r[0] for r in df.where("d = 2").select(M.round_even("x", 2)).collect()]
    assert whole == [0.0, 2.0, 2.0] and two == [0.12, 0.38]


def test_bands_are_half_open_and_keep_empty_ones(spark):
    edges = [0, 0.01, 0.25, 0.5, 0.75, 0.99, 1, 1.01]
    values = [-0.01, 0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0, 1.005, 1.01, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    labels = [r[0] for r in df.select(B.band("v", edges, B.half_open_labels(edges))).collect()]
    assert labels == [None, "[0.0, 0.01)", "[0.01, 0.25)", "[0.25, 0.5)", "[0.5, 0.75)", "[0.75, 0.99)", "[0.99, 1.0)",
                      "[1.0, 1.01)", "[1.0, 1.01)", None, None]
    few = B.band_frequency(df.where("v = 0"), "v", edges)
    assert [(r["freq"], r["perc"]) for r in few.orderBy("ordem").collect()] == [(1, 1.0)] + [(0, 0.0)] * 6


def test_right_closed_bands(spark):
    df = spark.createDataFrame([(0,), (20,), (21,), (50,), (51,)], "v int")
    labels = [r[0] for r in df.select(B.band("v", [0, 20, 50, float("inf")], ["a", "b", "c"], right=True)).collect()]
    assert labels == [None, "a", "b", "b", "c"]


def test_last_assignment_wins(spark):
    df = spark.createDataFrame([(1,), (5,), (10,), (None,)], "x int")
    value = M.last_wins([(F.col("x") > 0, "small"), (F.col("x") > 3, "middle"), (F.col("x") > 8, "large")], otherwise="none")
    assert [r[0] for r in df.select(value).collect()] == ["small", "middle", "large", "none"]


def test_first_value_skips_missing(spark):
    df = spark.createDataFrame([("e", 1, None), ("e", 2, "x"), ("e", 3, "y")], "k string, o int, v string")
    assert rows(df.groupBy("k").agg(M.first_present("v", ["o"]).alias("v")), "k") == [("e", "x")]


def test_keep_first_is_one_row_per_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, None)], "k int, o int, v string")
    assert rows(M.keep_first(df, ["k"], ["o"]), "k") == [(1, 2, "b"), (2, 9, None)]


def test_running_total_keeps_missing_amounts(spark):
    df = spark.createDataFrame([("e", 1, 5), ("e", 2, None), ("e", 3, 7)], "id string, ano int, v int")
    out = W.cumulative(df, "id", "ano", {"v": "t"}).orderBy("ano").collect()
    assert [r["t"] for r in out] == [5, None, 12]


def test_credit_recurrence(spark):
    amounts = [0, 5, 0, 0, 7, 3]
    df = spark.createDataFrame([("e", 2010 + i, v) for i, v in enumerate(amounts)], "id string, ano int, v int")
    out = W.credit_recurrence(df, "id", "ano", "v", "r").orderBy("ano").collect()
    # First row counts, then every row whose previous amount is not zero: 1, 1, 2, 2, 2, 3; zero where there is none.
    assert [r["r"] for r in out] == [0, 1, 0, 0, 2, 3]


def test_moving_average_waits_for_two_years(spark):
    df = spark.createDataFrame([("b", 1, 10.0), ("b", 2, 20.0), ("b", 3, 40.0)], "g string, ano int, v double")
    out = W.moving_average(df, "g", "ano", "v", "m").orderBy("ano").collect()
    assert [r["m"] for r in out] == [None, 15.0, 30.0]


def test_keys(spark):
    df = one(spark, "a string, b string", "12", None)
    assert df.select(S.compose_key("imovel", "a", "b")).first()[0] == "imovel-12"
    assert df.select(S.compose_key_strict(F.lit("imovel"), "b")).first()[0] is None
    assert one(spark, "t string", "R$ 1.2a3").select(S.digits_only("t")).first()[0] == 123


def test_money_text(spark):
    assert one(spark, "v double", 1234567.891).select(S.money_text("v")).first()[0] == "R$ 1.234.567,89"


def test_single_quota(spark):
    df = spark.createDataFrame(
        [("2020-01-31", 10, 10, 2020), ("2020-02-01", 10, 10, 2020), ("2021-01-05", 10, 10, 2020), ("2020-01-05", 9, 10, 2020), (None, 10, 10, 2020)],
        "d string, p int, b int, y int").withColumn("d", F.to_date("d"))
    assert [r[0] for r in df.select(S.single_quota("d", "p", "b", "y")).collect()] == [1, 0, 0, 0, 0]


def test_payment_status(spark):
    df = spark.createDataFrame([(10, 10), (0, 10), (4, 10), (11, 10), (0, 0)], "vlr_pago int, vlr_total_dam int")
    assert [r[0] for r in df.select(S.payment_status()).collect()] == ["paga", "nao_paga", "parcial", "paga_a_maior", "paga"]


def test_fill_everything_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, t string, m decimal(18,2)")
    assert tuple(C.fill_everything(df).first()) == (0, "0", Decimal("0.00"))


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert rows(C.union_all(a, b), "x") == [(1, 2), (3, None)]


def test_suffixes(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, 3)], "k int, v int")
    assert J.suffixed(a, b, ["k"]).columns == ["k", "v_x", "v_y"]
