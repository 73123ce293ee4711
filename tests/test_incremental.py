"""Balances that are kept equal those made anew, whatever order workbooks come and change in."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerspark.functions import labels as L
from ledgerspark.plans import jobs
from ledgerspark.plans import reports as R
from ledgerspark.plans.incremental import CARRIED, DAILY, FACTS, BalanceStore
from ledgerspark.sources import land_workbooks
from ledgerspark.streaming import KeptBalances, run_stream
from test_sources import debts, published, trial_balance

SCHEMA = "grp string, company string, source_file string, origin string, org string, item string, date date, receipt decimal(12,2), payment decimal(12,2)"


def facts_of(rng, grp, source, days, start=date(2024, 1, 5)):
    out = {}
    for _ in range(rng.randint(1, 12)):
        key = (grp, "К" + source, source, rng.choice(["касса", "банк"]), rng.choice("АБ"), rng.choice("xyz"), start + timedelta(rng.randrange(days)))
        out[key] = (*key, Decimal(rng.randint(0, 50)), Decimal(rng.randint(0, 5)))
    return list(out.values())


def store_of(spark, path):
    return BalanceStore(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ["item"], ["origin"])


def anew(spark, state):
    every = [f for facts in state.values() for f in facts]
    return rows(R.balances_by_day(spark.createDataFrame(every, SCHEMA), ["item"], ["origin"]))


@pytest.mark.parametrize("seed", [1, 2])
def test_updates_equal_a_full_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    store, state = store_of(spark, tmp_path), {}
    for step in range(5):
        batch, gone = {}, []
        for _ in range(rng.randint(1, 3)):
            key = (rng.choice(["Г", "Д 1/2"]), rng.choice("ab"))
            if key in state and rng.random() < 0.3:
                gone.append(key)
            elif key in state and rng.random() < 0.6:
                # a corrected workbook: some late facts are other ones
                old = sorted(state[key], key=lambda f: f[6])
                cut = rng.randrange(len(old) + 1)
                late = [f for f in facts_of(rng, *key, 40, date(2024, 3, 1)) if f[:7] not in {o[:7] for o in old[:cut]}]
                batch[key] = old[:cut] + late
            else:
                batch[key] = facts_of(rng, *key, rng.choice([20, 200]))
        gone = sorted({k for k in gone if k not in batch})
        facts = spark.createDataFrame([f for own in batch.values() for f in own], SCHEMA)
        empty = [k for k, own in batch.items() if not own]
        dropped = spark.createDataFrame([*gone, *empty], "grp string, source_file string") if gone or empty else None
        store.update(facts, dropped)
        state |= batch
        for k in gone:
            del state[k]
        got = store.daily()
        assert rows(got) == anew(spark, state), step
        assert rows(store.facts()) == sorted([tuple(float(v) if isinstance(v, Decimal) else v for v in f) for own in state.values() for f in own], key=lambda r: tuple((v is None, str(v)) for v in r))
    assert sorted(got.dtypes) == sorted(R.balances_by_day(spark.createDataFrame([], SCHEMA), ["item"], ["origin"]).dtypes)


def long_history(spark, years=3):
    return [("Г", "К", s, "касса", "А", i, date(2021, 1, 1) + timedelta(7 * w), Decimal(w % 9), Decimal(1)) for s in ("a", "b") for i in "xyz" for w in range(52 * years)]


def test_what_is_read_and_written_grows_with_the_changed_days(spark, tmp_path):
    history = long_history(spark)
    store = store_of(spark, tmp_path)
    assert store.update(spark.createDataFrame(history, SCHEMA)).since == {"Г": date(2021, 1, 1)}
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("*/grp=*/month=*")}
    read = {}
    for weeks in (1, 100):
        own = [f for f in history if f[2] == "a"]
        first = sorted({f[6] for f in own})[-weeks]
        corrected = [(*f[:7], f[7] + 1, f[8]) if f[6] >= first else f for f in own]
        done = store.update(spark.createDataFrame(corrected, SCHEMA))
        assert done.since == {"Г": first.replace(day=1)}
        read[weeks] = done.rows_read
        store.update(spark.createDataFrame(own, SCHEMA))
    assert 10 * read[1] < read[100] < len(history) and read[1] < 50
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("*/grp=*/month=*")}
    kept = [p for p in before if p.name < "month=2022-01"]
    assert kept and all(after[p] == before[p] for p in kept)
    # the same facts again change nothing
    assert store.update(spark.createDataFrame(history, SCHEMA)).since == {}


@pytest.mark.parametrize("stop", [DAILY, CARRIED, FACTS])
def test_an_interrupted_update_is_made_good_by_the_same_again(spark, tmp_path, monkeypatch, stop):
    history = long_history(spark, 1)
    store = store_of(spark, tmp_path)
    store.update(spark.createDataFrame(history, SCHEMA))
    own = [(*f[:7], f[7] + 2, f[8]) if f[6] > date(2021, 10, 1) else f for f in history if f[2] == "a"]
    replace = BalanceStore._replace

    def failing(self, name, *args):
        replace(self, name, *args)
        if name == stop:
            raise OSError("lost")

    monkeypatch.setattr(BalanceStore, "_replace", failing)
    with pytest.raises(OSError):
        store.update(spark.createDataFrame(own, SCHEMA))
    monkeypatch.undo()
    store.update(spark.createDataFrame(own, SCHEMA))
    want = anew(spark, {0: own, 1: [f for f in history if f[2] == "b"]})
    assert rows(store.daily()) == want
    # and the balances that are carried on are right, too
    late = [*own, ("Г", "К", "a", "касса", "А", "x", date(2022, 5, 1), Decimal(3), Decimal(0))]
    store.update(spark.createDataFrame(late, SCHEMA))
    assert rows(store.daily()) == anew(spark, {0: late, 1: [f for f in history if f[2] == "b"]})


def test_an_earlier_fact_of_another_key_gives_an_organisation_days(spark, tmp_path):
    """Days on which nothing changed by itself: the organisation has rows there only since the later fact."""
    base = ("Г", "К", "a", "касса")
    old = [(*base, "А", "x", date(2024, 1, 3), Decimal(5), Decimal(0)), (*base, "Б", "x", date(2024, 6, 1), Decimal(1), Decimal(0)), (*base, "А", "y", date(2024, 1, 2), Decimal(5), Decimal(0))]
    store = store_of(spark, tmp_path)
    store.update(spark.createDataFrame(old, SCHEMA))
    assert store.daily().where((F.col("org") == "А") & (F.col("date") > "2024-01-03")).count() == 0
    new = [*old, (*base, "А", "x", date(2024, 4, 20), Decimal(0), Decimal(2))]
    assert store.update(spark.createDataFrame(new, SCHEMA)).since == {"Г": date(2024, 1, 1)}
    assert rows(store.daily()) == anew(spark, {0: new})


def test_stream_with_kept_balances_equals_a_batch(spark, tmp_path):
    source, landed, out, checkpoint, kept, batch = (str(tmp_path / n) for n in ("landing", "landed", "out", "checkpoint", "kept", "batch"))
    names = ["ОСВ 50", "ОСВ 51", "ОСВ 50_51", "ОСВ 66_67"]
    (tmp_path / "landing").mkdir()

    def put(company, kind, content, grp="Г"):
        (tmp_path / "landing" / f"({grp}){kind}_{company}.xlsx").write_bytes(content)

    def run():
        run_stream(spark, source, landed, out, checkpoint, reports=names, balances=kept).awaitTermination()

    put("Альфа", L.TRIAL_BALANCE, trial_balance(3))
    put("Альфа", L.DEBT_BALANCE, debts())
    put("Гамма", L.TRIAL_BALANCE, trial_balance(2), "Д")
    run()
    put("Бета", L.TRIAL_BALANCE, trial_balance(9))  # another company extends the group
    put("Альфа", L.TRIAL_BALANCE, trial_balance(5))  # a corrected workbook
    (tmp_path / "landing" / f"(Д){L.TRIAL_BALANCE}_Дельта.xlsx").write_bytes(trial_balance(2))
    run()
    jobs.publish(spark, land_workbooks(spark, source), batch, names)
    for report in names:
        assert published(spark, out, report) == published(spark, batch, report), report
    assert KeptBalances(spark, kept).sync(landed)["trial"].since == {}
