import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark import functions as X


def one(spark, column, *values, names="abc"):
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n, _ in zip(names, values)))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "text, number",
    [("1 234,50", "1234.50"), ("-7,1", "-7.10"), ("5", "5.00"), ("1 000,5", "1000.50"), (None, None)],
)
def test_locale_number(spark, text, number):
    got = one(spark, X.parse_locale_number("a"), text)
    assert got == (None if number is None else Decimal(number))


def test_locale_number_fails_or_sets_aside_junk(spark):
    assert one(spark, X.parse_locale_number("a", strict=False), "junk") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, X.parse_locale_number("a"), "junk")


@pytest.mark.parametrize(
    "text, expected",
    [("02.01.2024", (2024, 1, 2)), ("1/2/2024", (2024, 1, 2)), ("31.02.2024", None), ("50.01", None), (None, None)],
)
def test_multi_date(spark, text, expected):
    assert one(spark, X.parse_multi_date("a", strict=False), text) == (None if expected is None else datetime.date(*expected))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("01.02.2023 0:00:00", (2023, 2, 1)),
        ("2/1/2023 12:00:00 AM", (2023, 2, 1)),
        ("01.02.2023", None),
        ("ООО Ромашка", None),
        ("13/13/2023 12:00:00 AM", None),
    ],
)
def test_multi_datetime(spark, text, expected):
    got = one(spark, X.parse_multi_datetime("a").cast("date"), text)
    assert got == (None if expected is None else datetime.date(*expected))


def test_tax_id(spark):
    assert one(spark, X.clean_tax_id("a"), "70.01234.0") == "701234"


@pytest.mark.parametrize(
    "name, tax_id, label",
    [("А", "77", "А (ИНН: 77)"), ("А", None, "А"), (None, "77", "nan (ИНН: 77)"), (None, None, None)],
)
def test_label_with_id(spark, name, tax_id, label):
    assert one(spark, X.label_with_id("a", "b"), name, tax_id) == label


@pytest.mark.parametrize(
    "text, label",
    [
        ("ООО А,7701", "ООО А (ИНН: 7701)"),
        ("Иванов, ", "Иванов"),
        ("-", "- (ИНН: -)"),
        ("a, b, 12", "a, b (ИНН:  12)"),
        ("x,", "x (ИНН: )"),
    ],
)
def test_split_last_comma(spark, text, label):
    assert one(spark, X.split_last_comma("a"), text) == label


@pytest.mark.parametrize(
    "account, classes",
    [
        ("66.01", ("Кредиты", "Основной долг", "Краткосрочная задолженность")),
        ("67.02", ("Кредиты", "Проценты", "Долгосрочная задолженность")),
        ("66.03", ("Займы", "Основной долг", "Краткосрочная задолженность")),
        ("67.04", ("Займы", "Проценты", "Долгосрочная задолженность")),
        ("66.05", ("Долговые ценные бумаги", "Основной долг", "Краткосрочная задолженность")),
    ],
)
def test_debt_classes(spark, account, classes):
    df = spark.createDataFrame([(account,)], "a string")
    assert tuple(df.select(*X.classify_debt("a").values()).first()) == classes


@pytest.mark.parametrize("receipt, kind", [(None, "Списание"), (1.0, "Поступление")])
def test_flow_type(spark, receipt, kind):
    df = spark.createDataFrame([(receipt,)], "receipt double")
    assert df.select(X.flow_type("receipt")).first()[0] == kind


def test_file_identity(spark):
    name = "(Группа 1)ОСВ 50-51_Ромашка.v2.xlsx"
    assert one(spark, X.file_group("a"), name) == "Группа 1"
    assert one(spark, X.file_company("a"), name) == "Ромашка"


def test_account_filter(spark):
    df = spark.createDataFrame([("50.01",), ("50.03",), ("50.23",), ("51",), ("51.1",), (None,)], "a string")
    cash = df.where(X.account_filter("a", prefix="50", exclude=("50.03", "50.23")))
    assert [r.a for r in cash.collect()] == ["50.01"]
    assert [r.a for r in df.where(X.account_filter("a", equals="51")).collect()] == ["51"]


def test_expressions_need_no_python(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string").select(
        X.parse_locale_number("a"), X.parse_multi_date("a"), X.clean_tax_id("a"), X.label_with_id("a", "b"),
        X.split_last_comma("a"), X.file_group("a"), F.lit(1),
    )
    assert "Python" not in df._jdf.queryExecution().toString()


def test_what_is_no_date_or_number_fails_unless_asked_otherwise(spark):
    from ledgerspark.operators import rejected_cells

    df = spark.createDataFrame([(1, "2024-01-05", "7"), (2, "06.01.2024", "1,239"), (3, None, None), (4, "1/6/2024", "x")], "row_no int, d string, n string")
    with pytest.raises(Exception, match="not a date: 2024-01-05"):
        df.select(X.parse_multi_date("d")).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(X.parse_locale_number("n")).collect()
    lenient = df.select(X.parse_multi_date("d", strict=False).alias("d"), X.parse_locale_number("n", strict=False).alias("n")).collect()
    assert [str(r.d) for r in lenient] == ["None", "2024-01-06", "None", "2024-01-06"]
    assert [r.n and float(r.n) for r in lenient] == [7, 1.239, None, None]
    rejected = rejected_cells(df, ["row_no"], dates=["d"], numbers=["n"]).collect()
    assert sorted(map(tuple, rejected)) == [(1, "d", "2024-01-05"), (4, "n", "x")]
