"""Column functions against the edge rows listed in FIXTURES.md §3."""

from pyspark.sql import functions as F

from marquee.functions.dates import parse_ymd_date
from marquee.functions.jsoncols import is_plain_list, with_json_lists
from marquee.functions.ratio import guarded_ratio
from marquee.functions.text import clean_feed_title, strip_leading_chars
from marquee.functions.validators import numeric_int, strict_float, strict_int


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def run(spark, values, fn):
    df = one_col(spark, values)
    value, reason = fn(F.col("v"))
    return [(r.value, r.reason) for r in df.select(value.alias("value"), reason.alias("reason")).collect()]


def test_numeric_int_link_ids(spark):
    out = run(spark, ["862", "862.0", "0114709", None, "x"], lambda c: numeric_int(c, label="id"))
    assert [v for v, _ in out] == [862, 862, 114709, -9999, None]
    assert out[4][1] == "id:not_numeric"
    assert all(r is None for _, r in out[:4])


def test_strict_int_metadata_ids(spark):
    out = run(spark, ["862", None, "1997-08-20", "-5", "99999999999999999999", "-9999"],
              lambda c: strict_int(c, label="id"))
    assert out[0] == (862, None)
    assert out[1] == (-9999, None)
    assert out[2][1] == "id:not_integer" and out[3][1] == "id:not_integer"
    assert out[4][1] == "id:out_of_range"
    assert out[5] == (-9999, None)


def test_imdb_strip_then_validate(spark):
    df = one_col(spark, ["tt0114709", "ttt1", "tt", "0", None])
    v, r = strict_int(strip_leading_chars(F.col("v"), "t"), label="imdb_id")
    rows = df.select(v.alias("v"), r.alias("r")).collect()
    assert [x.v for x in rows] == [114709, 1, None, 0, -9999]
    assert rows[2].r == "imdb_id:not_integer"


def test_strict_float(spark):
    vals = ["30000000", "1.", ".5", "1e6", "-1", "/x.jpg", "-999x999", None, "-999.999"]
    out = run(spark, vals, lambda c: strict_float(c, label="budget"))
    assert out[0] == (30000000.0, None)
    assert out[1] == (1.0, None)
    assert all(r == "budget:not_decimal" for _, r in out[2:7])
    assert out[7] == (-999.999, None)
    assert out[8] == (-999.999, None)


def test_dates(spark):
    df = one_col(spark, ["1995-10-30", "1995-1-3", " 1995-10-30", "1", None, "1995-02-30",
                         "1995-10-30x"])
    got = [r.d for r in df.select(parse_ymd_date(F.col("v")).alias("d")).collect()]
    assert str(got[0]) == "1995-10-30" and str(got[1]) == "1995-01-03"
    assert got[2:] == [None, None, None, None, None]


def test_json_lists(spark):
    vals = ["[{'id': 16, 'name': 'Animation'}]",
            "[{'name': \"Jerry's Films\", 'id': 3}]",
            "[{'name': None, 'id': 3}]",
            "[{'name': 'caf\\xe9', 'id': 4}]",
            None, "[]", " [ ] ", '[{"id": 1, "name": "a"}, {"name": "b", "id": -2}]',
            "[{'id': 1, 'name': 'a'},]", "[{'id': 1, 'name': 'a', 'x': [1, {'y': None}]}]", "[{'id': '1', 'name': 'a'}]",
            "[{'id': 1.5, 'name': 5}]", "[{'id': 12345678901234567890, 'name': 'a'}]", "[{'name': 'a\\/b', 'id': 1}]",
            "[{'id': 1}]", "[{'id': 1, 'name': 'a', 'id': 2}]", "[{}]",
            "{}", "junk", "[1, 2]", "[{'id': 1, 'name': 'a'}] and more", "[{'id\": 1, 'name': 'a'}]", "[{'id': 007, 'name': 'a'}]",
            "[\x01]", "[{'id': 1e999}]", "[" * 5000 + "]" * 5000]
    df = with_json_lists(one_col(spark, vals), [(F.col("v"), "j", "[]", "g")])
    rows = df.collect()
    assert [r.j for r in rows[:17]] == [
        '[{"id":16,"name":"Animation"}]', '[{"id":3,"name":"Jerry\'s Films"}]', '[{"id":3,"name":null}]',
        '[{"id":4,"name":"café"}]', "[]", "[]", "[]", '[{"id":1,"name":"a"},{"id":-2,"name":"b"}]',
        '[{"id":1,"name":"a"}]', '[{"id":1,"name":"a","x":[1,{"y":null}]}]', '[{"id":"1","name":"a"}]',
        '[{"id":1.5,"name":5}]', '[{"id":12345678901234567890,"name":"a"}]', '[{"id":1,"name":"a\\\\/b"}]',
        '[{"id":1}]', '[{"id":2,"name":"a"}]', "[{}]"]
    assert all(r.j__reason is None for r in rows[:17])
    assert all(r.j is None for r in rows[17:])
    assert [r.j__reason for r in rows[17:-1]] == ["g:not_a_list"] * 2 + ["g:unparseable"] * 6
    assert rows[-1].j__reason in ("g:too_deep", "g:unparseable")


def test_plain_lists_take_the_fast_path(spark):
    many = "[" + ", ".join(f"{{'id': {i}, 'name': 'n{i}'}}" for i in range(20_000)) + "]"
    rows = one_col(spark, [many, "[{'id': 1, 'name': 'a\\n'}]"]).select(is_plain_list(F.col("v")).alias("p")).collect()
    assert [r.p for r in rows] == [True, False]


def test_feed_title_cleaning(spark):
    df = one_col(spark, ["Wikipedia: Alpha", " Wikipedia: Beta", "Gamma ", "Wikipedia:\tDelta"])
    got = [r.t for r in df.select(clean_feed_title(F.col("v")).alias("t")).collect()]
    assert got == ["Alpha", "Wikipedia: Beta", "Gamma", "\tDelta"]


def test_ratio_guard_and_decimal_ties(spark):
    df = spark.createDataFrame([(1.0, 1000000.0), (1.0, 1000001.0), (5.0, 0.0), (5.0, None),
                                (6.0, 3.0)], "b double, r double")
    rows = df.select(guarded_ratio(F.col("b"), F.col("r"), "decimal").alias("d"),
                     guarded_ratio(F.col("b"), F.col("r"), "double").alias("x")).collect()
    assert rows[0].d == rows[1].d  # equal at six decimals -> same rank
    assert rows[0].x != rows[1].x
    assert float(rows[2].d) == -999.999 and rows[3].x == -999.999
    assert float(rows[4].d) == 2.0
    huge = spark.createDataFrame([(1e30, 1.0), (1.0, 1e30)], "b double, r double")
    assert [r.d for r in huge.select(guarded_ratio(F.col("b"), F.col("r"), "decimal").alias("d")).collect()] == [None, None]
