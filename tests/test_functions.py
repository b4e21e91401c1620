import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from smelter.functions import cleansing as c
from smelter.functions import dates, keys


def test_code_label_with_default(evaluate):
    values = ["M", " s ", "m", "X", "", None, "Married"]
    got = evaluate(lambda x: c.code_label(x, c.MARITAL_STATUS, c.UNKNOWN), values, "STRING")
    assert got == ["Married", "Single", "Married", "n/a", "n/a", "n/a", "n/a"]


def test_code_label_passes_through_and_is_idempotent(evaluate):
    def rule(x):
        return c.code_label(x, c.PRODUCT_LINE)

    got = evaluate(rule, ["R ", "m", " Custom ", None, "", "T", "S"], "STRING")
    assert got == ["Road", "Mountain", "Custom", None, "", "Touring", "Other Sales"]
    assert evaluate(rule, got, "STRING") == got


def test_future_flag(evaluate):
    as_of = dt.date(2020, 5, 1)
    values = [dt.date(2020, 5, 1), dt.date(2020, 5, 2), dt.date(2020, 4, 30), None]
    assert evaluate(lambda x: c.future_flag(x, as_of), values, "DATE") == [0, 1, 0, 0]


def test_future_flag_defaults_to_the_current_date(evaluate):
    assert evaluate(c.future_flag, [dt.date(1990, 1, 1), dt.date(9999, 1, 1)], "DATE") == [0, 1]


@pytest.mark.parametrize(("lowest", "default", "want"), [(0, 0, [0, 0, 0, 5]), (1, 1, [1, 1, 1, 5])])
def test_number_or_default(evaluate, lowest, default, want):
    assert evaluate(lambda x: c.number_or_default(x, lowest, default), [None, -3, 0, 5], "INT") == want


def test_end_or_null(frame):
    a, b = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    df = frame([(0, a, b), (1, b, a), (2, a, a), (3, a, None), (4, None, a)], "i INT, s DATE, e DATE")
    got = df.select("i", c.end_or_null(F.col("s"), F.col("e")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == [b, None, a, None, a]


def test_known_or(frame):
    df = frame([(0, "Male", "Female"), (1, "n/a", "Female"), (2, None, "Male"), (3, "n/a", None)], "i INT, a STRING, b STRING")
    got = df.select("i", c.known_or(F.col("a"), F.col("b")).alias("y")).orderBy("i").collect()
    assert [r.y for r in got] == ["Male", "Female", "Male", None]


def test_is_untrimmed(evaluate):
    assert evaluate(c.is_untrimmed, ["a", " a", "a ", "", " ", None], "STRING") == [False, True, True, False, True, None]


def test_key_forms(evaluate):
    assert evaluate(keys.customer_key_of_suffix, ["NASAW00011000", "AW00011000", "x", None], "STRING") == [
        "AW00011000", "AW00011000", "x", None,
    ]
    assert evaluate(keys.customer_key_of_dashed, ["AW-00011000", "A-W-1"], "STRING") == ["AW00011000", "AW1"]
    assert evaluate(keys.category_id, ["CO-RF-FR-R92B-58", "AB"], "STRING") == ["CO_RF", "AB"]
    assert evaluate(keys.product_number, ["CO-RF-FR-R92B-58", "CO-RF", None], "STRING") == ["FR-R92B-58", "", None]


def test_pseudonym_hashes_utf16(evaluate):
    names = ["Lee", "Müller", "", None]
    want = [None if n is None else hashlib.sha256(n.encode("utf-16-le")).hexdigest().upper() for n in names]
    assert evaluate(keys.pseudonym, names, "STRING") == want


def _python_date(n):
    try:
        return None if n is None or len(str(n)) != 8 else dt.datetime.strptime(str(n), "%Y%m%d").date()
    except ValueError:
        return None


def test_int_to_date_against_python(evaluate):
    values = [0, None, -20130101, 32154, 5489, 20130229, 20120229, 19000229, 20000229, 20131301, 20130100, 20130132]
    values += [20130431, 10000101, 99991231, 2147483647, 130105, 201301051]
    values += [y * 10000 + m * 100 + d for y in (1999, 2000, 2023) for m in range(0, 14) for d in range(0, 33)]
    assert evaluate(dates.int_to_date, values, "INT") == [_python_date(v) for v in values]


def test_is_invalid_day(evaluate):
    values = [20130101, 0, -1, 2013010, 20500101, 20500102, 18991231, 19000101, 123456789, None]
    want = [False, True, True, True, False, True, True, False, True, None]
    assert evaluate(dates.is_invalid_day, values, "INT") == want
