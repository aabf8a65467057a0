import duckdb
import math

from pyspark.sql import functions as F

from recprep.functions.random import uniform, uniform_sql
from recprep.functions.scalar import (
    blank_to_unknown, clip_outlier_to, decade_of, impute_blank, logistic_loss, parse_year,
)
from recprep.functions.arrays import list_get, list_tail, pad_left, pad_right, padding_mask

YEARS = ["1900", "1910", "1911", "2000", "2001", "2030", "2031", "", "abcd", "16", None,
         "1899", "2029"]


def test_decade_rule_matches_reference_buckets(spark):
    df = spark.createDataFrame([(y,) for y in YEARS], "y string")
    got = {r["y"]: (r["d"], r["c"]) for r in df.select(
        "y", decade_of("y").alias("d"), decade_of("y", calendar=True).alias("c")).collect()}
    # inclusive bounds, first match wins: 1910 -> 1900s, 2000 -> 1990s, 2030 -> 2020s
    assert got["1900"] == ("1900s", "1900s")
    assert got["1910"] == ("1900s", "1910s")
    assert got["1911"] == ("1910s", "1910s")
    assert got["2000"] == ("1990s", "2000s")
    assert got["2001"] == ("2000s", "2000s")
    assert got["2030"] == ("2020s", "unknown")
    assert got["2029"] == ("2020s", "2020s")
    assert got["2031"] == ("unknown", "unknown")
    assert got["1899"] == ("unknown", "unknown")
    for bad in ["", "abcd", "16", None]:
        assert got[bad] == ("unknown", "unknown")


def test_parse_year_is_four_digits_only(spark):
    df = spark.createDataFrame([("2001",), (" 1999 ",), ("12345",), ("99",)], "y string")
    assert [r[0] for r in df.select(parse_year("y")).collect()] == [2001, 1999, None, None]


def test_blank_impute_clip(spark):
    df = spark.createDataFrame([("",), (None,), ("5000",), ("12.5",), ("x",)], "v string")
    rows = df.select(blank_to_unknown("v").alias("u"),
                     impute_blank("v", 7.0).alias("i")).collect()
    assert [r["u"] for r in rows] == ["unknown", "unknown", "5000", "12.5", "x"]
    assert [r["i"] for r in rows] == [7.0, 7.0, 5000.0, 12.5, 7.0]
    c = df.select(clip_outlier_to(impute_blank("v", 7.0), 2000, 7.0).alias("c")).collect()
    assert [r["c"] for r in c] == [7.0, 7.0, 7.0, 12.5, 7.0]


def test_uniform_is_engine_independent(spark):
    df = spark.range(0, 50).select(F.col("id").cast("int").alias("a"),
                                   (F.col("id") * 7).cast("int").alias("b"))
    got = [r["u"] for r in df.select("a", uniform(42, "a", 3, "b").alias("u"))
           .orderBy("a").collect()]
    con = duckdb.connect()
    exp = [r[0] for r in con.sql(
        f"SELECT {uniform_sql(42, 'a', 3, 'b')} FROM (SELECT range::INT AS a, (range*7)::INT AS b "
        f"FROM range(50)) ORDER BY a").fetchall()]
    assert got == exp
    assert all(0.0 <= u < 1.0 for u in got)
    assert len(set(got)) == 50


def test_logistic_loss_stable(spark):
    df = spark.createDataFrame([(0.0, 1), (50.0, 0), (-50.0, 1), (2.0, 1)], "z double, y int")
    got = [r[0] for r in df.select(logistic_loss("z", "y")).collect()]
    def ref(z, y):
        return max(z, 0) - z * y + math.log1p(math.exp(-abs(z)))
    for g, (z, y) in zip(got, [(0.0, 1), (50.0, 0), (-50.0, 1), (2.0, 1)]):
        assert math.isclose(g, ref(z, y), rel_tol=1e-12)


def test_array_helpers(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "a array<int>")
    r = df.select(pad_right("a", 5).alias("r"), pad_left("a", 2).alias("l"),
                  list_tail("a", 2).alias("t"), list_get("a", -2).alias("g"),
                  padding_mask(pad_right("a", 4)).alias("m")).collect()
    assert r[0]["r"] == [1, 2, 3, 0, 0] and r[1]["r"] == [0, 0, 0, 0, 0]
    assert r[0]["l"] == [2, 3] and r[1]["l"] == [0, 0]
    assert r[0]["t"] == [2, 3] and r[1]["t"] == []
    assert r[0]["g"] == 2 and r[1]["g"] is None
    assert r[0]["m"] == [True, True, True, False]


def test_small_operators(spark):
    from recprep.functions.scalar import fill_null
    from recprep.operators.aggregates import cardinalities, check_dense_ids, continuous_stats
    from recprep.operators.filters import drop_columns, select_output, with_constants
    from recprep.operators.ordering import head_per_group
    from recprep.operators.setops import repeat_epochs, unique
    df = spark.createDataFrame([(1, 3), (1, 1), (2, 2), (2, None)], "user_id int, book_id int")
    assert sorted(r[0] for r in df.select(fill_null("book_id", 0)).collect()) == [0, 1, 2, 3]
    assert sorted(tuple(r) for r in head_per_group(df.dropna(), "user_id", ["book_id"], 1)
                  .collect()) == [(1, 1), (2, 2)]
    assert sorted(r[0] for r in unique(df, "user_id").collect()) == [1, 2]
    assert repeat_epochs(df, 3).count() == 12
    t = with_constants(df, pad=(0, "int"))
    assert drop_columns(t, "pad").columns == ["user_id", "book_id"]
    d = check_dense_ids(spark.createDataFrame([(1,), (2,), (2,), (3,)], "x int"), "x", 3).first()
    assert d["dense"] and d["n_distinct"] == 3
    c = {r["name"]: r["size"] for r in cardinalities({"u": (df, "user_id"), "rows": (df, None)})
         .collect()}
    assert c == {"u": 2, "rows": 4}
    s = spark.createDataFrame([("1",), ("",), ("3",), ("5000",), ("2",)], "v string")
    st = continuous_stats(s, "v").first()
    assert (st["min"], st["max"], st["median"]) == (1.0, 3.0, 2.0)
    ex = spark.createDataFrame([(1, 2, *range(10))], "user_id int, book_id int, language int, "
                               "is_ebook int, format int, publisher int, pub_decade int, "
                               "avg_rating int, num_pages int, is_read int, is_reviewed int, label int")
    assert select_output(ex).columns[:2] == ["user_id", "item_id"]
