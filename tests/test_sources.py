"""From workbooks in a folder to published reports, in one batch and as a stream."""

import pytest
from pyspark.sql import functions as F

from helpers import day, rows, workbook
from ledgerspark.functions import labels as L
from ledgerspark.plans import jobs
from ledgerspark.plans import reports as R
from ledgerspark.sources import Staging, land_workbooks, scope, scratch_dir, write_report
from ledgerspark.sources import workbooks as W
from ledgerspark.sources.workbooks import find_workbooks
from ledgerspark.streaming import run_stream
from ledgerspark.streaming.folder import affected_groups, land

TITLE = ["Отчёт"]


def trial_balance(last_day):
    head = ["Счет", "Статья движения денежных средств", "Организация", None, "Поступление", "Списание", "Остаток", None]
    body = [
        ["50.01"],
        ["ООО Ромашка"],
        ["01.01.2024 0:00:00", "Аренда", None, None, "1 000,50", None],
        [f"{last_day:02}.01.2024 0:00:00", "Аренда", None, None, 200, "50,5"],
        ["51"],
        ["ООО Ромашка"],
        ["1/2/2024 12:00:00 AM", "Счёт 1", None, None, None, "7"],
    ]
    return workbook([head, TITLE, TITLE, TITLE, TITLE, *body])


def bank():
    head = ["Дата", "Поступление", "Списание", "Назначение платежа", "Контрагент", "ИНН", "Вид операции", "Организация", "Банковский счет"]
    return workbook(
        [
            head,
            ["02.01.2024", "10,00", None, "Оплата", "А", 7701, "Покупка", "ООО Ромашка", "Счёт 1"],
            [day(1), None, "4", None, "А", 7701, None, "ООО Ромашка", "Счёт 1"],
            ["1/3/2024", None, "5", None, None, None, "Прочее", "ООО Ромашка", "Счёт 1"],
        ]
    )


def dictionary():
    head = ["Вид операции", "Статья движения денежных средств", "Вид движения", "Группа статей", "Операция"]
    return workbook(
        [
            head,
            ["Покупка", "Выручка", "Приток", "Текущие операции", L.RECEIPT],
            [None, "Прочее", "Отток", "Финансовые операции", L.PAYMENT],
            ["Касса1", "Аренда", "Приток аренды", "Текущие операции", L.RECEIPT],
            ["Касса2", "Аренда", "Второй", "Текущие операции", L.RECEIPT],
        ]
    )


def debts():
    head = ["Счет", "Кредитор", "Остаток", None, "Списание", "Поступление", "Остаток 2", None]
    body = [["66.01"], ["ООО Ромашка"], ["7700000001", "Банк"], ["Договор 1"], ["01.01.2024 0:00:00", None, None, None, "3", "100"],
            ["03.01.2024 0:00:00", None, None, None, "40", None]]
    return workbook([head, *[TITLE] * 6, *body])


def outline(*leaves, preamble=6):
    return workbook([*[TITLE] * preamble, *leaves])


def costs(amount):
    return outline((0, ["ООО Ромашка"]), (1, ["20"]), (2, ["60"]), (3, ["Вид"]), (4, ["Сырьё,77"]), (5, ["02.01.2024", amount]))


def revenue():
    return outline(
        (0, ["ООО Ромашка"]), (1, ["90.01"]), (2, ["62"]), (3, ["Вид"]), (4, ["Покупатель,77"]), (5, ["01.01.2024"]), (6, ["Док"]),
        (7, ["Оп 1", "120"]), (5, ["03.01.2024"]), (6, ["Док"]), (7, ["Оп 2", "60"]), preamble=8,
    )


def deductions():
    return outline((0, ["ООО Ромашка"]), (1, ["90.03"]), (2, ["68"]), (3, ["01.01.2024"]), (4, ["Док"]), (5, ["Оп 1", "20"]))


def fill(folder, group="Г", company="Альфа", last_day=3):
    files = {
        L.TRIAL_BALANCE: trial_balance(last_day), L.BANK_STATEMENTS: bank(), L.CASH_FLOW_DICTIONARY: dictionary(),
        L.DEBT_BALANCE: debts(), L.REVENUE: revenue(), L.DEDUCTIONS: deductions(), L.COST_OF_SALES: costs("30,5"),
        L.OTHER_INCOME: costs(8),
    }
    for report, content in files.items():
        (folder / f"({group}){report}_{company}.xlsx").write_bytes(content)


@pytest.fixture
def landed(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    fill(folder)
    (folder / "(Г)Заметки_Альфа.xlsx").write_bytes(workbook([TITLE]))
    (folder / "readme.txt").write_text("no workbook")
    return land_workbooks(spark, str(folder))


def test_landing_keeps_rows_levels_and_names(landed):
    assert {r.kind for r in landed.select("kind").distinct().collect()} == {
        L.TRIAL_BALANCE, L.BANK_STATEMENTS, L.CASH_FLOW_DICTIONARY, L.DEBT_BALANCE, L.REVENUE, L.DEDUCTIONS, L.COST_OF_SALES, L.OTHER_INCOME,
    }
    assert landed.select("grp", "company").distinct().collect() == [("Г", "Альфа")]
    sheet = W.outline_sheet(landed, L.COST_OF_SALES)
    assert rows(sheet.where("row_no >= 6"), "row_no", "level", "c0", "c1")[-1] == (9, 3, "Вид", None)
    assert rows(sheet.where("level = 5"), "c0", "c1") == [("02.01.2024", "30,5")]
    lines = rows(W.bank_statements(landed), "row_no", "date", "receipt", "inn", "op_type")
    assert lines[0] == (0, "02.01.2024", "10,00", "7701", "Покупка")
    assert lines[1] == (1, "01.01.2024 00:00:00", None, "7701", None)


def test_find_by_report_name(spark, tmp_path):
    fill(tmp_path)
    assert {r.kind for r in land_workbooks(spark, str(tmp_path), L.DEBT_BALANCE).collect()} == {L.DEBT_BALANCE}


def test_cash_flow_report(landed):
    flow = R.cash_flow(W.bank_statements(landed), W.dictionary(landed), W.trial_sheet(landed))
    got = rows(flow, "date", "origin", "counterparty", "cf_item", "item_group", "net_flow", "is_new_counterparty")
    named = "А (ИНН: 7701)"
    current = "Денежные потоки от текущих операций"
    assert got == sorted(
        [
            (day(2), L.BANK, named, "Выручка", current, 10, "Нет"),
            (day(1), L.BANK, named, "Прочее", "Денежные потоки от финансовых операций", -4, "Да"),
            (day(3), L.BANK, "-", "-", L.UNMAPPED_GROUP, -5, "Да"),
            (day(1), L.CASH, L.CASH, "Аренда", current, 1000.5, "Да"),
            (day(3), L.CASH, L.CASH, "Аренда", current, 200, "Нет"),
            (day(3), L.CASH, L.CASH, "Аренда", L.UNMAPPED_GROUP, -50.5, "Нет"),
        ],
        key=lambda r: tuple(map(str, r)),
    )


def test_debt_report(landed):
    got = rows(R.debt_daily(W.debt_sheet(landed)), "creditor", "contract", "date", "receipt", "payment", "closing")
    who = ("Банк (ИНН: 7700000001)", "Договор 1")
    assert got == [(*who, day(1), 100, 3, 97), (*who, day(2), 0, 0, 97), (*who, day(3), 0, 40, 57)]


def test_statement_report(landed):
    statement = R.pnl_statement(
        W.outline_sheet(landed, L.REVENUE), W.outline_sheet(landed, L.DEDUCTIONS), W.outline_sheet(landed, *jobs.OTHERS)
    )
    at_end = rows(statement.where(F.col("date") == day(3)), "indicator", "item", "closing")
    assert {(i, item): closing for i, item, closing in at_end} == {
        (L.REVENUE, "Покупатель (ИНН: 77)"): 160,
        (L.COST_OF_SALES, "Сырьё (ИНН: 77)"): -30.5,
        (L.OTHER_INCOME, "Сырьё,77"): 8,
        (L.GROSS_PROFIT, "-"): 129.5,
        (L.SALES_PROFIT, "-"): 129.5,
        (L.PRE_TAX_PROFIT, "-"): 137.5,
        (L.NET_PROFIT, "-"): 137.5,
    }


def published(spark, out, report):
    return rows(spark.read.option("header", True).csv(f"{out}/{report}"))


def test_csv_sink_round_trip_and_group_overwrite(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    daily = R.trial_balance_daily(W.trial_sheet(landed), R.CASH_DESK)
    write_report(daily, out, "ОСВ 50")
    table = spark.read.option("header", True).csv(f"{out}/ОСВ 50")
    assert table.columns == [
        "Организация", "Статья движения денежных средств", "Дата", "Начальный остаток", "Поступление", "Списание", "Конечный остаток",
        "Изменение", "grp",
    ]
    assert table.count() == 3
    write_report(daily.withColumn("grp", F.lit("Д")), out, "ОСВ 50")
    write_report(daily.where("date < '2024-01-02'"), out, "ОСВ 50")
    counts = dict(rows(spark.read.option("header", True).csv(f"{out}/ОСВ 50").groupBy("grp").count()))
    assert counts == {"Г": 1, "Д": 3}


def test_stream_of_two_drops_equals_one_batch(spark, tmp_path):
    landing, landed, out, checkpoint = (tmp_path / n for n in ("landing", "landed", "out", "checkpoint"))
    landing.mkdir()

    def run():
        run_stream(spark, str(landing), str(landed), str(out), str(checkpoint), reports=["ОДДС", "ОСВ 50"]).awaitTermination()

    fill(landing, company="Альфа", last_day=3)
    run()
    first = published(spark, out, "ОСВ 50")
    fill(landing, company="Бета", last_day=6)
    fill(landing, group="Другая", company="Гамма")
    run()
    jobs.publish(spark, land_workbooks(spark, str(landing)), str(tmp_path / "batch"), ["ОДДС", "ОСВ 50"])
    for report in ("ОДДС", "ОСВ 50"):
        assert published(spark, out, report) == published(spark, tmp_path / "batch", report)
    assert len(published(spark, out, "ОСВ 50")) > len(first)


def test_all_reports_are_published_and_each_workbook_is_decoded_once(spark, landed, tmp_path):
    opened = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            opened.add(int((batch["row_no"] == 0).sum()))
            yield batch

    counted = landed.mapInPandas(count, landed.schema)
    jobs.publish(spark, counted, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir()} == set(jobs.BUILD)
    assert all(published(spark, tmp_path / "out", report) for report in jobs.BUILD)
    assert opened.value == landed.where("row_no = 0").count()


def test_a_second_drop_replaces_a_workbook_and_reads_its_group_only(spark, tmp_path):
    landing, landed = tmp_path / "landing", str(tmp_path / "landed")
    landing.mkdir()
    fill(landing, company="Альфа", last_day=3)
    fill(landing, group="Другая", company="Гамма")
    land(find_workbooks(spark, str(landing)), landed)
    before = rows(spark.read.parquet(landed))
    batch = find_workbooks(spark, str(landing), "Альфа")
    land(batch, landed)
    assert rows(spark.read.parquet(landed)) == before
    plan = affected_groups(batch, landed)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grp" in plan or "PartitionFilters: [(grp" in plan or "PartitionFilters: [grp" in plan
    assert {r.grp for r in affected_groups(batch, landed).select("grp").distinct().collect()} == {"Г"}


def test_a_workbook_without_a_group_is_rejected(spark, tmp_path):
    fill(tmp_path)
    name = next(p for p in tmp_path.iterdir() if L.DEBT_BALANCE in p.name)
    name.rename(tmp_path / f"{L.DEBT_BALANCE}_Альфа.xlsx")
    with pytest.raises(Exception, match="no .group. in the name"):
        land_workbooks(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="no .group. in the name"):
        land(find_workbooks(spark, str(tmp_path)), str(tmp_path / "landed"))


def test_kinds_choose_workbooks_before_decoding(spark, tmp_path):
    fill(tmp_path)
    (tmp_path / f"(Г){L.DEBT_BALANCE}_broken.xlsx").write_bytes(b"no workbook")
    assert {r.kind for r in land_workbooks(spark, str(tmp_path), kinds=[L.REVENUE]).collect()} == {L.REVENUE}


def test_staging_writes_once_and_cleans_up(spark):
    import os

    with Staging(spark) as stage:
        staged = stage(spark.range(5))
        assert staged.count() == 5
        assert stage.path.startswith(scratch_dir(spark).rstrip("/"))
        folder = stage.path.removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def big_workbook(n):
    return workbook([TITLE, *[(i % 8, [f"{i % 50}", "текст", None, i]) for i in range(n)]])


def test_decoding_memory_does_not_grow_with_the_rows(spark):
    import tracemalloc

    peaks = []
    for n in (5_000, 80_000):
        content = big_workbook(n)
        tracemalloc.start()
        assert sum(1 for _ in W._sheet_rows(content)) == n + 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + (1 << 20)


def test_shared_strings_lie_in_one_buffer():
    strings = W.Strings()
    for text in ("", "а", "b\n", "日本", "x" * 1000):
        strings.append(text)
    assert [strings[i] for i in range(len(strings))] == ["", "а", "b\n", "日本", "x" * 1000]
    with pytest.raises(IndexError):
        strings[5]


def test_staged_tables_go_with_their_scope(spark):
    import os

    with scope():
        stage = Staging(spark)
        assert stage(spark.range(3)).count() == 3
        folder = stage.path.removeprefix("file:")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())
