"""Reports against a plain day-by-day restatement, on random rows with gaps and early ends."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import day, rows
from ledgerspark import operators as O
from ledgerspark.functions import labels as L
from ledgerspark.plans import reports as R

ONE = datetime.timedelta(days=1)
FACTS = "grp string, company string, source_file string, org string, item string, date date, receipt double, payment double"


def span(a, b):
    while a <= b:
        yield a
        a += ONE


def trial_balance_by_hand(data):
    """(source, org, item, date) -> (receipt, payment, opening, closing)."""
    moves, last_of_source = {}, {}
    for _, _, source, org, item, date, receipt, payment in data:
        moves[(source, org, item, date)] = (receipt, payment)
        last_of_source[source] = max(date, last_of_source.get(source, date))
    group_last = max(last_of_source.values())
    for (source, org, item, date), _ in list(moves.items()):
        if date == last_of_source[source] < group_last:
            moves[(source, org, item, group_last)] = (0, 0)
    dates_of_key, days_of_org = defaultdict(list), defaultdict(set)
    for source, org, item, date in moves:
        dates_of_key[(source, org, item)].append(date)
    for (source, org, _), dates in dates_of_key.items():
        days_of_org[(source, org)].update(span(min(dates), max(dates)))
    out = {}
    for (source, org, item), dates in dates_of_key.items():
        balance = 0
        for d in sorted(days_of_org[(source, org)]):
            if d >= min(dates):
                receipt, payment = moves.get((source, org, item, d), (0, 0))
                out[(source, org, item, d)] = (receipt, payment, balance, balance + receipt - payment)
                balance += receipt - payment
    return out


@pytest.mark.parametrize("seed", range(6))
def test_trial_balance_by_day(spark, seed):
    rng = random.Random(seed)
    data = {}
    for _ in range(rng.randint(5, 25)):
        source = rng.choice(["f1", "f2"])
        key = (source, rng.choice("ab"), rng.choice("xyz"), day(rng.randint(1, 28)))
        data[key] = ("g", source, *key, float(rng.randint(0, 9)), float(rng.randint(0, 9)))
    df = spark.createDataFrame(list(data.values()), FACTS)
    got = {
        tuple(r[:4]): tuple(r[4:])
        for r in rows(R.balances_by_day(df, ["item"]), "source_file", "org", "item", "date", "receipt", "payment", "opening", "closing")
    }
    assert got == trial_balance_by_hand(data.values())


def test_org_wide_gap_and_source_end(spark):
    data = [
        ("g", "c", "f", "o", "a", day(1), 1.0, 0.0), ("g", "c", "f", "o", "a", day(2), 1.0, 0.0),
        ("g", "c", "f", "o", "b", day(5), 1.0, 0.0), ("g", "c", "h", "p", "a", day(7), 1.0, 0.0),
    ]
    got = rows(R.balances_by_day(spark.createDataFrame(data, FACTS), ["item"]), "org", "item", "date", "closing")
    assert [(i, d.day) for o, i, d, _ in got if o == "o"] == [("a", 1), ("a", 2), ("a", 5), ("a", 6), ("a", 7), ("b", 5), ("b", 6), ("b", 7)]


def test_reports_in_one_table_keep_their_own_ends(spark):
    data = [("g", "c", "f", "o", "a", day(1), 1.0, 0.0, "1"), ("g", "c", "f", "o", "a", day(9), 1.0, 0.0, "2")]
    df = spark.createDataFrame(data, FACTS + ", origin string")
    got = rows(R.balances_by_day(df, ["item"], ["origin"]), "origin", "date")
    assert got == [("1", day(1)), ("2", day(9))]


COMPONENT = "grp string, company string, source_file string, indicator string, org string, item_kind string, item string, date date, change double"


def component_data(seed):
    rng = random.Random(seed)
    data = {}
    for _ in range(40):
        grp = rng.choice(["g", "h"])
        key = (grp, "c", f"f{grp}", rng.choice(L.COMPONENTS), rng.choice("ab"), "k", rng.choice("xy"), day(rng.randint(1, 20)))
        data[key] = (*key, float(rng.randint(-9, 9)))
    return list(data.values())


@pytest.mark.parametrize("seed", range(3))
def test_component_by_day_equals_the_composed_operators(spark, seed):
    df = spark.createDataFrame(component_data(seed), COMPONENT)
    keys = R.COMPONENT_KEYS
    extended = O.extend_to_group_end(df, ["grp", "indicator"], keys, ["change"])
    dense = O.densify_calendar(extended, keys, ["change"])
    seen = O.expand_seen_so_far(dense, [k for k in keys if k != "item"], ["item"], ["change"])
    composed = O.running_balance(seen, keys)
    cols = [*keys, "date", "change", "opening", "closing"]
    assert rows(R.components_by_day(df), *cols) == rows(composed, *cols)


@pytest.mark.parametrize("seed", range(3))
def test_statement_equals_the_composed_operators(spark, seed):
    df = spark.createDataFrame(component_data(seed), COMPONENT)
    carried = O.carry_forward_rows(R.components_by_day(df), ["grp"], ["org", "indicator"])
    lines = O.profit_unpivot(O.profit_cascade(O.spread_to_group_dates(O.pivot_indicators(carried))))
    lines = O.running_balance(lines, ["grp", "org", "indicator"])
    cols = ["grp", "org", "indicator", "item_kind", "item", "date", "change", "opening", "closing"]
    composed = O.fill_defaults(carried.unionByName(lines, allowMissingColumns=True), {"item_kind": "-", "item": "-"})
    statement = R.statement_from_facts(df)
    assert rows(statement, *cols) == rows(composed, *cols)

    net = statement.where(F.col("indicator") == L.NET_PROFIT).agg(F.sum("change")).first()[0]
    assert net == sum(r[-1] for r in component_data(seed))


def test_balances_connect_and_add_up(spark):
    df = spark.createDataFrame(component_data(9), COMPONENT)
    daily = R.components_by_day(df)
    ends = defaultdict(list)
    for *key, date, change, opening, closing in rows(daily, *R.COMPONENT_KEYS, "date", "change", "opening", "closing"):
        ends[tuple(key)].append((date, change, opening, closing))
    for series in ends.values():
        series.sort()
        assert series[0][2] == 0
        assert series[-1][3] == sum(s[1] for s in series)
        for before, after in zip(series, series[1:]):
            assert after[0] - before[0] == ONE and after[2] == before[3]


def test_long_sources_split_into_blocks_give_the_same_report(spark, monkeypatch):
    lines = []
    for i in range(40):
        if i % 9 == 0:
            lines.append((i, ["50.01", "50.02", "51"][i // 9 % 3], None, None, None))
        elif i % 5 == 1:
            lines.append((i, f"Общество {i % 2}", None, None, None))
        else:
            lines.append((i, f"{i % 7 + 1:02}.01.2024 0:00:00", "Статья" if i % 4 else None, f"{i},5", None))
    sheet = spark.createDataFrame(
        [("g", "c", "f", n + 4, *rest) for n, *rest in lines],
        "grp string, company string, source_file string, row_no int, stacked string, dim string, receipt string, payment string",
    )
    whole = rows(R.cash_and_bank_daily(sheet))
    assert whole
    monkeypatch.setattr(O.shape.forward_fill_steps, "__kwdefaults__", {**O.shape.forward_fill_steps.__kwdefaults__, "block_rows": 4})
    assert rows(R.cash_and_bank_daily(sheet)) == whole
