from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from tutorlake.functions import coding, days, numbers, privacy


def values(spark, data, expression, kind="string"):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(data)], f"n int, v {kind}")
    return [r[0] for r in frame.orderBy("n").select(expression(F.col("v"))).collect()]


def test_masks(spark):
    assert values(spark, ["Wang", "X", "", None], privacy.mask_name) == ["Wxx", "Xxx", "xx", None]
    phones = ["13812345678", "138123456789", "123", None]
    assert values(spark, phones, privacy.mask_phone) == ["138*****5678", "138*****5678", "*****", None]


def test_codes(spark):
    codes = ["1", "2", "3", "4", "5", None]
    assert values(spark, codes, coding.register_source) == ["PC", "Mobile", "App", "WeChat", "other", "other"]
    assert values(spark, codes, coding.platform) == ["PC", "APP", "Other", "Other", "Other", "Other"]


def test_score_bands_at_their_bounds(spark):
    scores = [Decimal(s) for s in ("0.0", "20.0", "20.1", "40.0", "60.0", "60.1", "100.0", "100.1")] + [None]
    expected = ["0-20", "0-20", "20-40", "20-40", "40-60", "60-80", "80-100", None, None]
    assert values(spark, scores, coding.score_band, "decimal(4,1)") == expected


def test_pass_and_fail_share_no_score(spark):
    scores = [Decimal(s) for s in ("-1.0", "0.0", "60.0", "60.1", "100.0", "101.0")]
    assert values(spark, scores, coding.failed, "decimal(4,1)") == [False, True, True, False, False, False]
    assert values(spark, scores, coding.passed, "decimal(4,1)") == [False, False, False, True, True, False]


def test_whole_numbers_default_to_zero(spark):
    texts = ["12", " 7 ", "12.9", "", "abc", None, "-3", "99999999999", "99999999999.9", "9" * 25]
    assert values(spark, texts, numbers.int_or_zero) == [12, 7, 12, 0, 0, 0, -3, 99999999999, 99999999999, None]


def test_scores_round_half_up(spark):
    texts = ["0.25", "0.24", "99.95", "x", None, "1e2"]
    expected = [Decimal("0.3"), Decimal("0.2"), Decimal("100.0"), None, None, Decimal("100.0")]
    assert values(spark, texts, numbers.tenth) == expected


def test_percent_text_rounds_ties_to_even(spark):
    ratios = [0.125, 0.375, 1.0, 0.004, 0.336, None]
    assert values(spark, ratios, numbers.percent_text, "double") == ["12%", "38%", "100%", "0%", "34%", "0%"]


def test_whole_units_cut_fractions(spark):
    spans = values(spark, [2999, 3000, 0], lambda v: numbers.whole_units(F.lit(0).cast("bigint"), v), "bigint")
    assert spans == [2, 3, 0]


def test_share_of_empty_whole_is_null(spark):
    frame = spark.createDataFrame([(1, 2), (0, 0)], "a bigint, b bigint")
    got = [r[0] for r in frame.select(numbers.share(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.33"), None]


def test_addresses(spark):
    texts = ["1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "", None, "a.b.c.d"]
    assert values(spark, texts, numbers.ipv4_number) == [16909060, 4294967295, None, None, None, None, None]


def test_day_texts(spark):
    assert values(spark, ["20190722", None], days.day_to_date_text) == ["2019-07-22", None]
