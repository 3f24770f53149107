"""Check flags: three-way match, two-way match, freshness boundary (FIXTURES 3.2)."""

import datetime as dt

from tablewatch.functions import freshness_flag, match_flag, type_length_flag


def test_three_way_match(spark):
    rows = [(1, 1, 1, "Y"), (None, 1, 1, ""), (1, None, 1, "N"), (1, 1, 2, "N")]
    df = spark.createDataFrame(rows, "src long, tgt long, leg long, want string")
    got = df.select(match_flag("src", "tgt", "leg").alias("flag"), "want").collect()
    assert [r.flag for r in got] == [r.want for r in got]


def test_two_way_match_null_target_fails(spark):
    df = spark.createDataFrame([(5, None), (None, 5), (5, 5), (5, 6)], "src long, tgt long")
    assert [r[0] for r in df.select(match_flag("src", "tgt")).collect()] == ["N", "", "Y", "N"]


def test_freshness_is_strict(spark):
    t = dt.datetime(2024, 1, 31, 12, 0, 0)
    rows = [(None,), (t - dt.timedelta(hours=24),), (t - dt.timedelta(hours=23, minutes=59),)]
    df = spark.createDataFrame(rows, "changed timestamp_ntz")
    assert [r[0] for r in df.select(freshness_flag("changed", t)).collect()] == ["", "N", "Y"]


def test_type_length_null_length_is_one_and_suffix_exempt(spark):
    rows = [
        ("TEXT", None, "TEXT", 1, "O_ONE", "Y"),
        ("NUMBER", None, "FLOAT", None, "O_WID", "Y"),
        ("NUMBER", None, "FLOAT", None, "O_WID  ", "Y"),  # trailing blanks trimmed
        ("NUMBER", None, "FLOAT", None, "o_wid", "N"),  # case-sensitive
        ("TEXT", 10, "TEXT", 20, "O_LEN", "N"),
    ]
    df = spark.createDataFrame(rows, "rt string, rl int, tt string, tl int, name string, want string")
    got = df.select(type_length_flag("rt", "rl", "tt", "tl", "name", "WID").alias("f"), "want").collect()
    assert [r.f for r in got] == [r.want for r in got]
