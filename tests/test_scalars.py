"""Text to value, one table of cases per function."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sunledger.functions import scalars as S


def evaluate(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.y for r in rows.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    cases = {
        "(5)": "-5", "5-": "-5", "1,234.5": "1234.5", "-1.0": "-1.0", " 7 ": "7", "+3": "3", "1e3": "1000",
        "5.": "5", "1,2,3": "123", ".5": "0.5", "007": "7", "¤12": "12", "1,234.5E-1": "123.45",
        "abc": None, "": None, " ": None, "NaN": None, "-(5)": None, "(-5)": None, "- 5": None, "1e": None,
        ".": None, "1.2.3": None, "1 2": None, "0x1": None, "1,2.3,4": None, "٣": None, "1d": None, "5--": None,
        "1e40": None,
    }
    values = evaluate(spark, list(cases), lambda x: S.number(S.number_text(x)).cast("double"))
    assert dict(zip(cases, values)) == {k: None if v is None else float(v) for k, v in cases.items()}
    good = [k for k, v in cases.items() if v is not None]
    assert evaluate(spark, good, lambda x: S.number_display(S.number_text(x))) == [cases[k] for k in good]


def test_stored_numbers_are_rounded_once(spark):
    texts = ["1.005", "0.0000004999999995", "1e-3", "123456789012.1234565", "1234567890123"]
    stored = evaluate(spark, texts, lambda x: S.numeric_value(S.number_text(x), "decimal", "KW_to_W"))
    assert [None if v is None else str(v) for v in stored] == ["1005.000000", "0.000500", "1.000000", None, None]
    plain = evaluate(spark, texts, lambda x: S.numeric_value(S.number_text(x), "decimal", "unknown"))
    assert str(plain[3]) == "123456789012.123457" and plain[4] is None
    doubles = evaluate(spark, ["1.005", "4.35", "1E2"], lambda x: S.numeric_value(S.number_text(x), "double", "mw_to_w"))
    assert doubles == [1005000.0, 4350000.0, 1e8]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-03-15T10:00:00Z", datetime(2026, 3, 15, 10)),
        ("2026-03-15T10:00:00+02:00", datetime(2026, 3, 15, 8)),
        ("2026-03-15 10:00:00.1234567", datetime(2026, 3, 15, 10, 0, 0, 123456)),
        (" 2026-3-5 ", datetime(2026, 3, 5)),
        ("2026-03-15 10:00", datetime(2026, 3, 15, 10)),
        ("2026-03-15 10:00:00 +01:00", datetime(2026, 3, 15, 9)),
        ("2026-03-15 10:00 GMT", datetime(2026, 3, 15, 10)),
        ("03/15/2026 10:30", datetime(2026, 3, 15, 10, 30)),
        ("3/5/2026 1:05:06 PM", datetime(2026, 3, 5, 13, 5, 6)),
        ("2026/03/15 10:00:01", datetime(2026, 3, 15, 10, 0, 1)),
        ("15 Mar 2026 10:00", datetime(2026, 3, 15, 10)),
        ("Mar 15, 2026", datetime(2026, 3, 15)),
        ("Sun, 15 Mar 2026 10:00:00 GMT", datetime(2026, 3, 15, 10)),
        ("2026", None), ("10:00", None), ("not-a-datetime", None), ("", None), ("2026-13-01", None),
        ("2026-03-15 25:00", None),
    ],
)
def test_times(spark, text, expected):
    assert evaluate(spark, [text], lambda x: S.parse_time(x).cast("timestamp_ntz")) == [expected]


def test_whole_numbers_and_flags(spark):
    assert evaluate(spark, ["12", " +7 ", "12.5", "1e3", "", "x", "3000000000"], lambda x: S.to_whole(x, "int")) == [
        12, 7, None, None, None, None, None,
    ]
    assert evaluate(spark, ["3000000000"], lambda x: S.to_whole(x, "long")) == [3000000000]
    assert evaluate(spark, ["true", " False\t", "TRUE", "1", "yes", "t", ""], S.to_flag) == [
        True, False, True, None, None, None, None,
    ]


def test_blank(spark):
    assert evaluate(spark, ["", " ", "\t\r\n", "\u00a0\u2003", None, "a", " a", "\u200b"], S.is_blank) == [
        True, True, True, True, True, False, False, False,
    ]
