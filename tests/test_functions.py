from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from namelens import functions as fn


def apply(rows, values, make, ddl="v string"):
    df = rows([(v,) for v in values], ddl)
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


def test_normalize_name(rows):
    values = [None, "", "   ", " O'Brien-José 3 ", "123", "Mary Ann", "MARY"]
    assert apply(rows, values, fn.normalize_name) == [
        None, None, None, "obrienjos", None, "maryann", "mary",
    ]
    assert apply(rows, [" O'Brien-José 3 "], lambda c: fn.normalize_name(c, unicode=True)) == ["obrienjosé"]


def test_normalize_zip5(rows):
    values = ["98101-1234", "1234", "A1B2C3D4E5", None, " 98101 "]
    assert apply(rows, values, fn.normalize_zip5) == ["98101", None, "12345", None, "98101"]


def test_normalize_gender(rows):
    values = ["m", " MALE ", "Female", "f", "U", "", None]
    assert apply(rows, values, fn.normalize_gender) == ["M", "M", "F", "F", None, None, None]


@pytest.mark.parametrize(
    "path, expected",
    [
        ("uploads/client_a-1/batch_b-2/u-u_my_file.csv", ("a-1", "b-2", "u-u_my_file.csv", "my_file.csv")),
        ("uploads/misc/batch_b/x.csv", (None, "b", "x.csv", "x.csv")),
        ("uploads/client_a/x.csv", ("a", None, "x.csv", "x.csv")),
        ("client_a/batch_1/batch_2/u_f.csv", ("a", "1", "u_f.csv", "f.csv")),
        (None, (None, None, None, None)),
    ],
)
def test_parse_upload_path(rows, path, expected):
    df = rows([(path,)], "p string")
    parts = fn.parse_upload_path("p")
    assert tuple(df.select(*parts.values()).first()) == expected


def test_safe_casts(rows):
    assert apply(rows, ["12", " 7 ", "x", "", None, "12.5"], fn.try_number) == [12, 7, None, None, None, 13]
    day = dt.date(2020, 12, 31)
    assert apply(rows, ["2020-12-31", "12/31/2020", "31-Dec-2020", "soon", None], fn.try_date) == [
        day, day, day, None, None,
    ]


def test_share_is_exact_and_null_for_zero(rows):
    df = rows([(2, 3), (0, 0), (8999996, 10000000)], "a bigint, b bigint")
    out = [r[0] for r in df.select(fn.share(F.col("a"), F.col("b"))).collect()]
    assert out == [Decimal("0.666667"), None, Decimal("0.900000")]


def test_record_order(rows):
    df = rows([("10",), ("9",), ("a",), ("2b",)], "record_id string")
    ordered = [r[0] for r in df.orderBy(*fn.record_order("record_id")).collect()]
    assert ordered == ["9", "10", "2b", "a"]


def test_sql_functions_agree_with_the_columns(spark, rows):
    values = [None, "", " O'Brien-José 3 ", "MALE ", "f", "Female", "x", "98101-1234", "12", "1a2b3c4d5e6", "  "]
    fn.register_functions(spark)
    df = rows([(v,) for v in values], "v string")
    for name in ("normalize_name", "normalize_zip5", "normalize_gender"):
        got = df.select(F.expr(f"{name}(v)").alias("a"), getattr(fn, name)("v").alias("b")).collect()
        assert [r.a for r in got] == [r.b for r in got]
