import datetime as dt

from pyspark.sql import functions as F

from stopline.functions import numeric as num
from stopline.functions import text
from stopline.functions import timecols as tc
from tests.conftest import at


def one(spark, expression, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(expression).first()[0]


def test_service_day_starts_at_three_local(spark):
    cases = {
        "2026-08-13 06:59:00": dt.date(2026, 8, 12),  # 02:59 in New York
        "2026-08-13 07:00:00": dt.date(2026, 8, 13),  # 03:00
        "2026-08-13 04:05:00": dt.date(2026, 8, 12),  # 00:05
        "2026-08-13 02:30:00": dt.date(2026, 8, 12),  # 22:30 the evening before
        "2026-12-01 08:00:00": dt.date(2026, 12, 1),  # 03:00 in winter
    }
    for text_, day in cases.items():
        assert one(spark, tc.service_date_norm(F.col("t")), t=at(text_)) == day


def test_local_day_of_week_counts_from_sunday(spark):
    assert one(spark, tc.local_dow(F.col("t")), t=at("2026-08-16 12:00:00")) == 0
    assert one(spark, tc.local_dow(F.col("t")), t=at("2026-08-16 02:00:00")) == 6  # still Saturday in New York


def test_rounding_rules(spark):
    assert one(spark, tc.whole_seconds(F.col("m")), m=2_500_000) == 2
    assert one(spark, tc.whole_seconds(F.col("m")), m=3_500_000) == 4
    assert one(spark, tc.int_seconds(F.col("m")), m=2_500_000) == 3
    assert one(spark, num.cycles_missed(F.col("g"), F.col("m")), g=66.0, m=66.0) == 0
    assert one(spark, num.cycles_missed(F.col("g"), F.col("m")), g=330.0, m=66.0) == 4


def test_pct_text(spark):
    assert one(spark, num.pct_text(F.col("a"), F.col("b")), a=1, b=8) == "12.50%"
    assert one(spark, num.pct_text(F.col("a"), F.col("b")), a=0, b=0) == "n/a"


def test_iso_round_trip(spark):
    assert one(spark, tc.iso_utc(F.col("t")), t=at("2026-08-13 02:30:00")) == "2026-08-13T02:30:00.000000Z"
    parse = lambda s: one(spark, F.unix_seconds(tc.parse_iso(F.col("s"))), s=s)
    assert parse("2026-08-12T21:19:30-04:00") == parse("2026-08-13T01:19:30") == int(at("2026-08-13 01:19:30").timestamp())
    assert parse("") is None and parse("soon") is None


def test_classify_reason(spark):
    cases = [
        ("HTTPSConnectionPool: Max retries exceeded", 2, 3, "upstream unreachable (1 of 3 batches)"),
        ("got 429 from server", 3, 3, "rate limited by the upstream API"),
        ("HTTP 503 from upstream", 0, 3, "upstream server error (3 of 3 batches)"),
        ("row 503 rejected", 1, 3, "poll failed (2 of 3 batches)"),
        ("db.connect failed after 3 attempts", 0, 3, "warehouse unreachable"),
        ("HTTP 503: read timed out", 2, 3, "upstream unreachable (1 of 3 batches)"),
        ("code 15031 http", 3, 3, "poll failed"),
    ]
    for error, ok, total, wanted in cases:
        got = one(spark, text.classify_reason(F.col("e"), F.col("a"), F.col("b")), e=error, a=ok, b=total)
        assert got == wanted, error
    unknown = spark.range(1).select(text.classify_reason(F.lit("x"), F.lit(None).cast("int"), F.lit(3)))
    assert unknown.first()[0] == "poll failed"


def test_truncate_text(spark):
    cut = lambda s: one(spark, text.truncate_text(F.col("s"), 20), s=s)
    assert cut("x" * 20) == "x" * 20
    assert cut("x" * 21) == "xxxxx... [truncated]"
