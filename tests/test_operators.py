import random

import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from ledgerspark import functions as X
from ledgerspark import operators as O
from ledgerspark.functions import labels as L

M = "decimal(18,2)"


def facts(spark, data, keys="org string, item string"):
    return spark.createDataFrame(data, f"{keys}, date date, change double").withColumn("change", F.col("change").cast(M))


# --- shape ---


def test_outline_keeps_ancestors_until_replaced(spark):
    sheet = spark.createDataFrame(
        [
            ("f", 0, 0, "Орг", None),
            ("f", 1, 3, "Вид 1", None),
            ("f", 2, 4, "Статья 1", None),
            ("f", 3, 5, "01.01.2024", "1"),
            ("f", 4, 3, "Вид 2", None),
            ("f", 5, 5, "02.01.2024", "2"),
            ("g", 0, 5, "03.01.2024", "3"),
        ],
        "source_file string, row_no int, level int, c0 string, c1 string",
    )
    flat = O.outline_flatten(sheet, {0: "org", 3: "kind", 4: "item", 5: "date"}, "date")
    assert rows(flat, "source_file", "org", "kind", "item", "date", "change") == [
        ("f", "Орг", "Вид 1", "Статья 1", "01.01.2024", "1"),
        ("f", "Орг", "Вид 2", "Статья 1", "02.01.2024", "2"),
        ("g", None, None, None, "03.01.2024", "3"),
    ]


def test_cash_classes(spark):
    df = spark.createDataFrame([("50.01",), ("ООО А",), ("01.02.2023 0:00:00",), ("01.02.2023",), (None,)], "stacked string")
    got = rows(O.classify_stacked(df, X.cash_bank_rules), "stacked", "account", "org", "date")
    assert ("50.01", "50.01", None, None) in got
    assert ("ООО А", None, "ООО А", None) in got
    assert ("01.02.2023 0:00:00", None, None, day(1, 2).replace(year=2023)) in got
    assert ("01.02.2023", "01.02.2023", None, None) in got
    assert (None, None, None, None) in got


def test_debt_classes_keep_org_as_contract(spark):
    data = [("66.01", None), ("ООО А", None), ("7701234567", "Банк"), ("Договор 1", None), ("770123456", None)]
    df = spark.createDataFrame(data, "stacked string, creditor string")
    got = rows(O.classify_stacked(df, X.debt_rules, "creditor"), "stacked", "account", "org", "creditor", "contract")
    assert got == [
        ("66.01", "66.01", None, None, None),
        ("770123456", None, None, None, "770123456"),
        ("7701234567", None, None, "Банк (ИНН: 7701234567)", None),
        ("Договор 1", None, None, None, "Договор 1"),
        ("ООО А", None, "ООО А", None, "ООО А"),
    ]


@pytest.mark.parametrize("block_rows", [3, 7, 1 << 20])
def test_forward_fill_in_blocks_equals_plain_fill(spark, block_rows):
    rng = random.Random(5)
    data = []
    for source in "ab":
        for i in range(60):
            data.append((source, i, rng.choice([None, None, "x", "y"]), rng.choice([None, None, None, f"v{i}"])))
    df = spark.createDataFrame(data, "source_file string, row_no int, k string, v string")
    want, keys, seen = [], {}, {}
    for source, i, k, v in data:
        keys[source] = k or keys.get(source)
        key = keys[source]
        if v is not None:
            seen[(source, key)] = v
        want.append((source, i, key, seen.get((source, key)) if key else None))
    got = O.forward_fill_steps(df, [(["k"], []), (["v"], ["k"])], block_rows=block_rows)
    assert rows(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_forward_fill_null_key_gives_null(spark):
    df = spark.createDataFrame([("f", 0, None, "a"), ("f", 1, "k", "b"), ("f", 2, "k", None)], "source_file string, row_no int, k string, v string")
    assert rows(O.forward_fill(df, ["v"], within=["k"]), "row_no", "v") == [(0, None), (1, "b"), (2, "b")]


# --- sums, calendar, balances ---


def test_ledger_sum_drops_null_keys_and_counts_nulls_as_zero(spark):
    df = facts(spark, [("a", "x", day(1), 1.0), ("a", "x", day(1), 2.0), (None, "x", day(1), 5.0), ("b", "y", day(1), None)])
    assert rows(O.ledger_sum(df, ["org", "item", "date"], ["change"])) == [("a", "x", day(1), 3.0), ("b", "y", day(1), 0.0)]


def test_running_balance(spark):
    df = facts(spark, [("a", "x", day(1), 5.0), ("a", "x", day(2), -2.0), ("a", "x", day(4), 3.0)])
    got = rows(O.running_balance(df, ["org", "item"]), "date", "opening", "closing")
    assert got == [(day(1), 0, 5), (day(2), 5, 3), (day(4), 3, 6)]


def test_densify_fills_the_days_between(spark):
    df = facts(spark, [("a", "x", day(1), 5.0), ("a", "x", day(4), -2.0)])
    dense = O.densify_calendar(df, ["org", "item"], ["change"])
    assert rows(dense, "date", "change") == [(day(1), 5), (day(2), 0), (day(3), 0), (day(4), -2)]
    assert rows(O.densify_calendar(dense, ["org", "item"], ["change"])) == rows(dense)


def test_date_gap(spark):
    df = facts(spark, [("a", "x", day(1), 5.0), ("a", "x", day(4), -2.0)])
    assert rows(O.date_gap(df, ["org", "item"]), "date", "gap_days") == [(day(1), None), (day(4), 3)]


def test_seen_so_far_skips_days_the_scope_lacks(spark):
    data = [("o", "a", day(1), 1.0), ("o", "a", day(2), 1.0), ("o", "b", day(5), 1.0), ("o", "b", day(6), 1.0)]
    got = O.expand_seen_so_far(facts(spark, data), ["org"], ["item"], ["change"])
    assert rows(got, "item", "date", "change") == [
        ("a", day(1), 1), ("a", day(2), 1), ("a", day(5), 0), ("a", day(6), 0), ("b", day(5), 1), ("b", day(6), 1),
    ]


def test_extension_by_source_and_by_key(spark):
    data = [("g", "f1", "x", day(9), 1.0), ("g", "f1", "y", day(10), 2.0), ("g", "f2", "x", day(12), 3.0)]
    df = facts(spark, data, "grp string, source_file string, item string")
    by_source = O.extend_to_group_end(df, ["grp"], ["source_file"], ["change"])
    assert rows(by_source, "source_file", "item", "date", "change")[:3] == [
        ("f1", "x", day(9), 1), ("f1", "y", day(10), 2), ("f1", "y", day(12), 0),
    ]
    assert by_source.count() == 4
    by_key = O.extend_to_group_end(df, ["grp"], ["source_file", "item"], ["change"])
    assert ("f1", "x", day(12), 0) in rows(by_key, "source_file", "item", "date", "change")
    assert by_key.count() == 5


def test_carry_forward_repeats_the_last_day(spark):
    df = spark.createDataFrame(
        [("g", "o", "i1", day(1), 1.0, 0.0, 1.0), ("g", "o", "i1", day(1), 2.0, 0.0, 2.0), ("g", "o", "i2", day(3), 4.0, 1.0, 5.0)],
        "grp string, org string, indicator string, date date, change double, opening double, closing double",
    )
    got = rows(O.carry_forward_rows(df, ["grp"], ["org", "indicator"]), "indicator", "date", "change", "opening", "closing")
    assert len(got) == 7
    assert ("i1", day(2), 0, 2, 2) in got and ("i1", day(3), 0, 1, 1) in got


def test_date_spans_merge(spark):
    data = [("a", day(1), day(3)), ("a", day(2), day(2)), ("a", day(4), day(5)), ("a", day(8), day(9)), ("a", day(8), day(8))]
    df = spark.createDataFrame(data, "org string, first_date date, last_date date")
    spans = O.date_spans(df, ["org"]).first().coverage
    assert [tuple(s) for s in spans] == [(day(1), day(5)), (day(8), day(9))]


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "n int, s string")
    assert rows(O.profile_counts(df)) == [("n", "int", 2, 2), ("s", "string", 2, 1)]


# --- mapping and flows ---

DICTIONARY = "grp string, company string, row_no int, op_type string, cf_item string, direction string"


def test_dictionary_lookup_is_null_safe_and_fans_out(spark):
    entries = spark.createDataFrame(
        [("g", "c", 1, "t", "i1", L.RECEIPT), ("g", "c", 2, "t", "i2", L.RECEIPT), ("g", "c", 3, None, "i3", L.PAYMENT), ("g", "d", 4, "t", "i4", L.RECEIPT)],
        DICTIONARY,
    )
    df = spark.createDataFrame(
        [(1, "g", "c", "t", L.RECEIPT), (2, "g", "c", None, L.PAYMENT), (3, "g", "c", "t", L.PAYMENT)],
        "n int, grp string, company string, op_type string, flow_type string",
    )
    got = rows(O.map_dictionary(df, entries, "op_type", ["cf_item"]), "n", "cf_item", "dict_row_no")
    assert got == [(1, "i1", 1), (1, "i2", 2), (2, "i3", 3), (3, None, -1)]


def test_first_dictionary_entry_wins(spark):
    entries = spark.createDataFrame([("g", "c", 9, "late", "i", L.RECEIPT), ("g", "c", 3, "early", "i", L.RECEIPT)], DICTIONARY)
    df = spark.createDataFrame([("g", "c", "i", L.RECEIPT)], "grp string, company string, cf_item string, flow_type string")
    got = O.map_dictionary(df, entries, "cf_item", ["op_type"], first_only=True)
    assert rows(got, "cf_item", "op_type") == [("i", "early")]


def test_net_of_equals_the_fanned_out_join(spark):
    df = spark.createDataFrame([("a", 100.0), ("a", 50.0), ("b", 10.0), (None, 1.0)], "k string, change double")
    ded = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 4.0)], "k string, change double")
    assert rows(O.net_of(df, ded, ["k"])) == [("a", 197), ("a", 97), ("b", 10), (None, -3)]
    summed = df.groupBy("k").agg(F.sum("change").alias("change"), F.count("change").alias("n"))
    assert rows(O.net_of(summed, ded, ["k"], rows="n"), "k", "change") == [("a", 2 * 150 - 2 * 3), ("b", 10), (None, -3)]


def test_two_way_rows_are_split(spark):
    df = spark.createDataFrame([(1, 10.0, 4.0), (2, 7.0, 0.0), (3, 0.0, 5.0)], "n int, receipt double, payment double")
    got = rows(O.signed_flows(O.split_two_way(df)), "n", "flow_type", "net_flow", "inflow", "outflow")
    assert got == [
        (1, L.RECEIPT, 10, 10, None), (1, L.PAYMENT, -4, None, 4), (2, L.RECEIPT, 7, 7, None), (3, L.PAYMENT, -5, None, 5),
    ]


def test_bank_row_with_both_sides_is_one_inflow(spark):
    df = spark.createDataFrame([(L.RECEIPT, 10.0, 4.0)], "flow_type string, receipt double, payment double")
    assert rows(O.signed_flows(df), "net_flow", "inflow", "outflow") == [(14, 14, None)]


def test_first_seen_flags_one_row(spark):
    df = spark.createDataFrame(
        [("o", "c", day(2), 1), ("o", "c", day(1), 2), ("o", "c", day(1), 3), (None, "c", day(1), 4), ("o", "d", None, 5)],
        "org string, cp string, date date, row_no int",
    )
    got = O.flag_first_seen(df, ["org", "cp"], ["date", "row_no"])
    assert rows(got, "row_no", "is_new_counterparty") == [(1, "Нет"), (2, "Да"), (3, "Нет"), (4, "Нет"), (5, "Нет")]


# --- statement ---


def test_profit_cascade(spark):
    values = dict(zip(L.COMPONENTS, [100.0, -40.0, -10.0, -5.0, 3.0, -2.0, -9.0]))
    df = spark.createDataFrame([("g", "o", day(1), k, v) for k, v in values.items()], "grp string, org string, date date, indicator string, change double")
    got = dict(rows(O.profit_unpivot(O.profit_cascade(O.pivot_indicators(df))), "indicator", "change"))
    assert got == {L.GROSS_PROFIT: 60, L.SALES_PROFIT: 45, L.PRE_TAX_PROFIT: 46, L.NET_PROFIT: 37}


def test_profit_lines_cover_every_org_on_every_day(spark):
    df = facts(
        spark,
        [("g", "a", L.REVENUE, day(1), 5.0), ("g", "a", L.COST_OF_SALES, day(4), -2.0), ("g", "b", L.REVENUE, day(3), 7.0)],
        "grp string, org string, indicator string",
    )
    bounds = spark.createDataFrame([("g", day(1), day(5))], "grp string, start_date date, end_date date")
    got = rows(O.profit_lines(df, bounds).where(F.col("indicator") == L.NET_PROFIT), "org", "date", "change", "opening", "closing")
    assert got == [
        ("a", day(1), 5, 0, 5), ("a", day(2), 0, 5, 5), ("a", day(3), 0, 5, 5), ("a", day(4), -2, 5, 3), ("a", day(5), 0, 3, 3),
        ("b", day(1), 0, 0, 0), ("b", day(2), 0, 0, 0), ("b", day(3), 7, 0, 7), ("b", day(4), 0, 7, 7), ("b", day(5), 0, 7, 7),
    ]


def test_union_with_origin_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1)], "cf_item string, n int")
    b = spark.createDataFrame([("y", 2)], "bank_account string, n int")
    got = rows(O.union_with_origin({L.CASH: a, L.BANK: b}), "origin", "cf_item", "bank_account", "n")
    assert got == [(L.BANK, None, "y", 2), (L.CASH, "x", None, 1)]


def test_recode_and_defaults(spark):
    df = spark.createDataFrame([("Текущие операции", None), ("Прочее", "p")], "item_group string, purpose string")
    got = rows(O.fill_defaults(O.recode(df, "item_group", L.ITEM_GROUPS), {"purpose": "-"}))
    assert got == [("Денежные потоки от текущих операций", "-"), ("Прочее", "p")]


# --- headers ----------------------------------------------------------------------------------


@pytest.mark.parametrize("block_rows", [5, 1 << 20])
@pytest.mark.parametrize("share", [0.05, 0.6])
def test_fill_from_headers_equals_the_steps_one_by_one(spark, block_rows, share):
    rng = random.Random(block_rows + int(share * 100))
    value = lambda *names: rng.choice(names) if rng.random() < share else None
    table = [(s, i, value("66", "67"), value("А", "Б"), value("x", "y"), i * 10) for s in ("a", "b", "c") for i in range({"a": 23, "b": 4, "c": 61}[s]) if rng.random() < 0.9]
    df = spark.createDataFrame(table, "source_file string, row_no int, account string, org string, contract string, amount int").repartition(3)
    steps = [(["account"], []), (["org"], ["account"]), (["contract"], ["account", "org"])]
    want = rows(O.forward_fill_steps(df, steps, block_rows=block_rows))
    got = O.fill_from_headers(df, steps, block_rows=block_rows)
    assert rows(got) == want and got.columns == df.columns
    assert rows(O.fill_from_headers(df.limit(0), steps)) == []


def test_fill_from_headers_sorts_the_detail_rows_once(spark):
    df = spark.createDataFrame([("a", i, "66" if i == 0 else None, None, i) for i in range(9)], "source_file string, row_no int, account string, org string, amount int")
    filled = O.fill_from_headers(df, [(["account"], []), (["org"], ["account"])])
    plan = filled._jdf.queryExecution().sparkPlan().toString()
    # windows over all rows carry the amount; those over headers have the header filter below them
    details = [line for line in plan.splitlines() if "Window" in line and "_state" in line]
    assert len(details) == 1
