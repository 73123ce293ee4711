"""Reports published together and complete by group; the identity of workbooks; the two streams of a folder."""

import time
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import day, rows, workbook
from ledgerspark.functions import labels as L
from ledgerspark.operators import profile_counts
from ledgerspark.plans import jobs
from ledgerspark.plans import reports as R
from ledgerspark.sources import Publication, Staging, land_workbooks, recover, workbooks, write_report
from ledgerspark.sources.files import Files
from ledgerspark.sources.sinks import published
from ledgerspark.streaming import gate, landing, run_stream
from test_sources import TITLE, bank, debts, dictionary, fill, trial_balance
from test_sources import published as shown

DAILY = "org string, cf_item string, date date, opening decimal(12,3), receipt decimal(12,3), payment decimal(12,3), closing decimal(12,3), change decimal(12,3), grp string"


def daily(spark, *groups, amount=1):
    lines = [("О", "Аренда", day(1), *[Decimal(v) for v in (0, amount, 0, amount, amount)], g) for g in groups]
    return spark.createDataFrame(lines, DAILY)


def groups_of(out, report):
    return sorted(p.name for p in (Path(out) / report).glob("grp=*"))


def receipts(spark, out, report):
    return dict(rows(spark.read.option("header", True).csv(f"{out}/{report}"), "grp", "Поступление"))


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")


def test_named_groups_without_rows_lose_their_folder(spark, out):
    with Publication(spark, out) as p:
        p.write(daily(spark, "а", "б", "в: г/д"), "ОСВ 50")
    with Publication(spark, out) as p:
        p.write(daily(spark, "а", "в: г/д", amount=2), "ОСВ 50", ["а", "б"])
    assert receipts(spark, out, "ОСВ 50") == {"а": "2.00", "в: г/д": "1.00"}
    with Publication(spark, out) as p:
        p.write(daily(spark, "б"), "ОСВ 50")
    assert receipts(spark, out, "ОСВ 50") == {"б": "1.00"}
    with Publication(spark, out) as p:
        p.write(daily(spark), "ОСВ 50", ["б"])
    assert groups_of(out, "ОСВ 50") == []


def test_nothing_is_visible_before_everything_is_written(spark, out):
    with Publication(spark, out) as p:
        p.write(daily(spark, "а"), "ОСВ 50")
        assert groups_of(out, "ОСВ 50") == []
    with pytest.raises(ZeroDivisionError), Publication(spark, out) as p:
        p.write(daily(spark, "а", amount=5), "ОСВ 50")
        raise ZeroDivisionError
    assert receipts(spark, out, "ОСВ 50") == {"а": "1.00"}
    assert [n.name for n in Path(out).iterdir()] == ["ОСВ 50"]


@pytest.mark.parametrize("after", [0, 1, 2])
def test_an_interrupted_swap_is_finished(spark, out, monkeypatch, after):
    with Publication(spark, out) as p:
        p.write(daily(spark, "а", "б", "в"), "ОСВ 50")
    p = Publication(spark, out)
    p.write(daily(spark, "а", "б", amount=3), "ОСВ 50", ["а", "б", "в"])
    move, done = Files.move, []

    def failing(self, source, target):
        if "grp=" in source:
            if len(done) == after:
                raise OSError("lost")
            done.append(source)
        move(self, source, target)

    monkeypatch.setattr(Files, "move", failing)
    if after < 2:
        with pytest.raises(OSError):
            p.commit()
    else:
        delete = Files.delete
        monkeypatch.setattr(Files, "delete", lambda self, name="": None if name.startswith("_manifest") else delete(self, name))
        p.commit()  # all moved, but the manifest stays
    monkeypatch.undo()
    recover(spark, out)
    assert receipts(spark, out, "ОСВ 50") == {"а": "3.00", "б": "3.00"}
    assert [n.name for n in Path(out).iterdir()] == ["ОСВ 50"]


def test_profile_comes_from_the_write_itself(spark, out):
    table = daily(spark, "а", "б").withColumn("cf_item", F.when(F.col("grp") == "а", F.col("cf_item")))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "")
    with Publication(spark, out) as p:
        p.write(table, "ОСВ 50")
    spark.sparkContext.setJobGroup("plain", "")
    write_report(table, f"{out}-plain", "ОСВ 50")
    jobs_of = [len(tracker.getJobIdsForGroup(g)) for g in ("observed", "plain")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs_of[0] == jobs_of[1] > 0
    assert sorted(p.profiles["ОСВ 50"]) == rows(profile_counts(published(table, "ОСВ 50")))


def test_a_failing_report_leaves_all_published_ones(spark, tmp_path, out, monkeypatch):
    landing_folder = tmp_path / "landing"
    landing_folder.mkdir()
    fill(landing_folder)
    names = ["ОСВ 50", "ОСВ 51"]
    profiles = jobs.publish(spark, land_workbooks(spark, str(landing_folder)), out, names)
    assert {r: p[0][2] for r, p in profiles.items()} == {r: len(shown(spark, out, r)) for r in names}
    before = {r: shown(spark, out, r) for r in names}
    fill(landing_folder, last_day=9)
    monkeypatch.setitem(jobs.BUILD, "ОСВ 51", lambda sources: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.publish(spark, land_workbooks(spark, str(landing_folder)), out, names)
    assert {r: shown(spark, out, r) for r in names} == before


# --- identity -----------------------------------------------------------------------------------


def two_folders(tmp_path, first, second, name=f"(Г){L.DEBT_BALANCE}_Альфа.xlsx"):
    for sub, content in (("a", first), ("b", second)):
        (tmp_path / sub).mkdir(exist_ok=True)
        (tmp_path / sub / name).write_bytes(content)
    return tmp_path / "a" / name, tmp_path / "b" / name


def other_debts():
    """Another layout: the account stands in another row, and a row number means another thing."""
    head = ["Счет", "Кредитор", None, None, "Списание", "Поступление"]
    body = [["67.01"], ["ООО Лютик"], ["7700000002", "Фонд"], ["Договор 9"], ["02.01.2024 0:00:00", None, None, None, None, "7"], ["67.02"],
            ["02.01.2024 0:00:00", None, None, None, None, "11"]]
    return workbook([head, *[TITLE] * 7, *body])


def closing(rows_of):
    with Staging(rows_of.sparkSession) as stage:
        facts = R.debt_facts(workbooks.debt_sheet(rows_of), stage)
        return rows(facts.groupBy("org", "creditor").agg(F.sum(F.col("receipt") - F.col("payment")).alias("closing")))


def test_same_named_workbooks_of_two_folders_are_two(spark, tmp_path):
    files = tmp_path / "in"
    files.mkdir()
    first, second = two_folders(files, debts(), other_debts())
    both = closing(land_workbooks(spark, str(files)))
    apart = [closing(land_workbooks(spark, str(f.parent))) for f in (first, second)]
    assert [r[:2] for r in both] == [("ООО Лютик", "Фонд (ИНН: 7700000002)"), ("ООО Ромашка", "Банк (ИНН: 7700000001)")]
    assert both[1] == apart[0][0] and both[1][2] == 57
    landed = land_workbooks(spark, str(files))
    assert landed.groupBy("source_file", "row_no").count().where("count > 1").count() == 0
    assert rows(landed.select("grp", "company").distinct()) == [("Г", "Альфа")]


def test_one_content_in_two_folders_is_one(spark, tmp_path):
    files, landed = tmp_path / "in", str(tmp_path / "landed")
    files.mkdir()
    first, second = two_folders(files, debts(), debts())
    alone = rows(land_workbooks(spark, str(first.parent)))
    assert rows(land_workbooks(spark, str(files))) == alone
    assert landing.land(workbooks.find_workbooks(spark, str(files)), landed) == [(L.DEBT_BALANCE, "Г")]
    assert rows(landing.landed_rows(spark, landed)) == alone
    # the content stays as long as one path has it
    first.write_bytes(other_debts())
    assert landing.land(workbooks.find_workbooks(spark, str(first.parent)), landed) == [(L.DEBT_BALANCE, "Г")]
    assert rows(landing.landed_rows(spark, landed)) == rows(land_workbooks(spark, str(files)))
    # the same again changes nothing
    assert landing.land(workbooks.find_workbooks(spark, str(files)), landed) == []
    paths = [r["path"] for r in landing.files(spark, landed).collect()]
    assert len(paths) == 2
    assert landing.withdraw(spark, landed, [p for p in paths if "/b/" in p]) == [(L.DEBT_BALANCE, "Г")]
    assert rows(landing.landed_rows(spark, landed)) == rows(land_workbooks(spark, str(first.parent)))
    assert landing.withdraw(spark, landed, paths) == [(L.DEBT_BALANCE, "Г")]
    assert landing.landed_rows(spark, landed).count() == 0 and landing.files(spark, landed).count() == 0
    assert landing.withdraw(spark, landed, paths) == []


# --- streams --------------------------------------------------------------------------------------


def folders(tmp_path):
    made = [tmp_path / n for n in ("landing", "landed", "out", "checkpoint")]
    made[0].mkdir()
    return [str(p) for p in made]


def test_stream_refreshes_what_an_arrival_concerns(spark, tmp_path, monkeypatch):
    source, landed, out, checkpoint = folders(tmp_path)
    (tmp_path / "archive").mkdir()
    built = []
    for name in ("ОСВ 50", "ОСВ 66_67"):
        monkeypatch.setitem(jobs.BUILD, name, lambda s, name=name, build=jobs.BUILD[name]: built.append(name) or build(s))

    def run(**options):
        built.clear()
        run_stream(spark, source, landed, out, checkpoint, reports=["ОСВ 50", "ОСВ 66_67"], **options).awaitTermination()
        return sorted(set(built))

    def put(grp, kind, content, company="Альфа"):
        (Path(source) / f"({grp}){kind}_{company}.xlsx").write_bytes(content)

    for grp in ("Г", "Д"):
        put(grp, L.DEBT_BALANCE, debts())
        put(grp, L.TRIAL_BALANCE, trial_balance(3))
    # however the drop is split, it is landed before anything is published
    assert run(batch_files=1, archive=str(tmp_path / "archive")) == ["ОСВ 50", "ОСВ 66_67"]
    assert groups_of(out, "ОСВ 66_67") == ["grp=Г", "grp=Д"]
    before = shown(spark, out, "ОСВ 50")
    stamp = {p: p.stat().st_mtime_ns for p in Path(out).glob("*/grp=Д/part*")}
    put("Г", L.DEBT_BALANCE, other_debts())
    assert run() == ["ОСВ 66_67"]
    assert shown(spark, out, "ОСВ 50") == before and {p: p.stat().st_mtime_ns for p in Path(out).glob("*/grp=Д/part*")} == stamp
    assert {r[0] for r in rows(spark.read.option("header", True).csv(f"{out}/ОСВ 66_67").where("grp = 'Г'"), "Организация")} == {"ООО Лютик"}
    # a corrected workbook that is empty empties its group
    put("Г", L.DEBT_BALANCE, workbook([["Счет"], *[TITLE] * 6]))
    assert run() == ["ОСВ 66_67"]
    assert groups_of(out, "ОСВ 66_67") == ["grp=Д"] and groups_of(out, "ОСВ 50") == ["grp=Г", "grp=Д"]
    # an archived workbook is not read again, and its rows stay
    assert run() == []
    assert landing.files(spark, landed).count() == 4


def test_archive_keeps_every_version(spark, tmp_path):
    source, landed, out, checkpoint = folders(tmp_path)
    archive, name = tmp_path / "archive", f"(Г){L.DEBT_BALANCE}_Аль [1] %20фа.xlsx"
    (Path(source) / "sub").mkdir()
    for content in (debts(), other_debts(), workbook([["Счет"], *[TITLE] * 6])):
        (Path(source) / "sub" / name).write_bytes(content)
        run_stream(spark, source, landed, out, checkpoint, reports=["ОСВ 66_67"], archive=str(archive)).awaitTermination()
    assert not list(Path(source).rglob("*.xlsx"))
    kept = list(archive.rglob("*.xlsx"))
    assert len(kept) == 3 and {p.parent.name for p in kept} == {"sub"} and {p.name for p in kept} == {name}
    assert groups_of(out, "ОСВ 66_67") == [] and landing.files(spark, landed).count() == 1


NEEDS = {"a": ["x", "y"], "b": ["x"]}


@pytest.mark.parametrize(
    "kinds, waiting, first, last, now, due, again",
    [
        ({"x"}, {"a", "b"}, 0, 0, 5, set(), 10),  # still coming in
        ({"x"}, {"a", "b"}, 0, 0, 10, {"b"}, 100),  # quiet: what is complete
        ({"x"}, {"a"}, 0, 50, 55, set(), 60),
        ({"x"}, {"a"}, 0, 50, 100, {"a"}, None),  # waited long enough
        ({"x", "y"}, {"a"}, 0, 50, 60, {"a"}, None),
        ({"x", "y"}, {"a"}, 0, 95, 99, set(), 100),  # patience ends before quiet begins
    ],
)
def test_when_a_report_is_due(kinds, waiting, first, last, now, due, again):
    assert gate.decide(NEEDS, kinds, waiting, first, last, now, 10, 100) == (due, again)


def wait_for(condition, seconds=90):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end
        time.sleep(0.5)


def test_a_split_drop_is_published_whole_and_waits_no_longer_than_patience(spark, tmp_path):
    source, landed, out, checkpoint = folders(tmp_path)
    put = lambda grp, kind, content: (Path(source) / f"({grp}){kind}_Альфа.xlsx").write_bytes(content)
    put("Г", L.BANK_STATEMENTS, bank())
    put("Г", L.TRIAL_BALANCE, trial_balance(3))
    put("Д", L.DEBT_BALANCE, debts())
    stream = run_stream(spark, source, landed, out, checkpoint, reports=["ОДДС", "ОСВ 66_67"], every="1 second", settle=1, patience=3600)
    try:
        wait_for(lambda: groups_of(out, "ОСВ 66_67") == ["grp=Д"])
        assert groups_of(out, "ОДДС") == []  # no dictionary yet
        put("Г", L.CASH_FLOW_DICTIONARY, dictionary())
        wait_for(lambda: groups_of(out, "ОДДС") == ["grp=Г"])
        assert stream.isActive
    finally:
        stream.stop()
    batch = str(tmp_path / "batch")
    jobs.publish(spark, land_workbooks(spark, source), batch, ["ОДДС"])
    assert shown(spark, out, "ОДДС") == shown(spark, batch, "ОДДС")
    # what never gets its partners is published when patience ends
    put("Е", L.BANK_STATEMENTS, bank())
    stream = run_stream(spark, source, landed, out, checkpoint, reports=["ОДДС", "ОСВ 66_67"], every="1 second", settle=0, patience=2)
    try:
        wait_for(lambda: groups_of(out, "ОДДС") == ["grp=Г", "grp=Е"])
    finally:
        stream.stop()
    assert not stream.isActive


# --- cells that cannot be read --------------------------------------------------------------------


def spoilt_costs():
    return workbook([*[TITLE] * 6, (0, ["ООО Ромашка"]), (3, ["Вид"]), (4, ["Сырьё,77"]), (5, ["02.01.2024", "5"]), (5, ["32.01.2024", "7"]), (5, ["03.01.2024", "9 руб"])])


def spoilt_deductions():
    return workbook([*[TITLE] * 6, (0, ["ООО Ромашка"]), (3, ["01.01.2024"]), (4, ["Док"]), (5, ["Оп 1", "20"]), (3, ["вчера"]), (5, ["Оп 1", "1"])])


def test_unreadable_cells_are_set_aside_by_the_same_pass(spark, tmp_path, out):
    source = tmp_path / "landing"
    source.mkdir()
    fill(source)
    landed = land_workbooks(spark, str(source))
    jobs.publish(spark, landed, f"{out}-clean", set_aside=True)
    jobs.publish(spark, landed, f"{out}-strict")
    for report in jobs.BUILD:
        assert shown(spark, f"{out}-clean", report) == shown(spark, f"{out}-strict", report)
    name = lambda kind: f"(Г){kind}_Альфа.xlsx"
    (source / name(L.COST_OF_SALES)).write_bytes(spoilt_costs())
    (source / name(L.DEDUCTIONS)).write_bytes(spoilt_deductions())
    head = ["Дата", "Поступление", "Списание", "Организация"]
    (source / name(L.BANK_STATEMENTS)).write_bytes(workbook([head, ["02.01.2024", "10,00", None, "О"], ["2024", "1", "2", "О"], ["03.01.2024", "x", "y", "О"]]))
    landed = land_workbooks(spark, str(source))
    with pytest.raises(Exception, match="not a date|CAST_INVALID_INPUT|cannot be cast"):
        jobs.publish(spark, landed, f"{out}-strict")
    opened = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            opened.add(int((batch["row_no"] == 0).sum()))
            yield batch

    jobs.publish(spark, landed.mapInPandas(count, landed.schema), out, set_aside=True)
    assert opened.value == landed.where("row_no = 0").count()
    cells = {
        sheet: rows(spark.read.option("header", True).csv(f"{out}/{jobs.REJECTED} {sheet}"), "row_no", "column", "text")
        for sheet in (L.BANK_STATEMENTS, L.DEDUCTIONS, R.COSTS)
    }
    assert cells == {
        L.BANK_STATEMENTS: [("1", "date", "2024"), ("2", "payment", "y"), ("2", "receipt", "x")],
        L.DEDUCTIONS: [("10", "date", "вчера")],
        R.COSTS: [("11", "change", "9 руб"), ("10", "date", "32.01.2024")][::-1],
    }
    flow = spark.read.option("header", True).csv(f"{out}/ОДДС").where(F.col("Источник") == L.BANK)
    assert rows(flow, "Дата", "Денежный поток") == [("2024-01-02", "10.00")]
    costs = spark.read.option("header", True).csv(f"{out}/ОФР").where((F.col("Показатель") == L.COST_OF_SALES) & (F.col("Дата") == "2024-01-03"))
    assert {r[0] for r in rows(costs, "Конечный остаток")} == {"-5.00"}
