"""Registered queries, each with the SQL of the same result where SQL can say it.

The SQL follows the step-by-step definition of an operator (fill in days, add zero rows, sum again,
then a window), whatever shape the Spark plan has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark import functions as X
from ledgerspark import operators as O
from ledgerspark.functions import labels as L
from ledgerspark.plans import reports as R
from ledgerspark.plans.incremental import BalanceStore
from ledgerspark.sources import workbooks as W
from ledgerspark.sources.publication import Publication
from ledgerspark.sources.sinks import published, write_report
from ledgerspark.sources.staging import Staging
from ledgerspark.streaming import KeptBalances, land, landed_rows

from . import bindings as B
from .books import workbooks

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = with_views(sql, *views)
        return fn

    return register


def with_views(sql: str, *views: str) -> str:
    """Put the bindings (and any ``name AS (...)`` steps ahead of the last SELECT) into one WITH."""
    steps, _, select = sql.rpartition("=>")
    parts = [B.PLACES_SQL, *[B.VIEWS[v] for v in views]]
    if steps.strip():
        parts.append(steps.strip())
    return "WITH " + ",".join(parts) + "\n" + select.strip()


# --- SQL pieces -----------------------------------------------------------------------------

FILE = "grp, company, source_file"
UP_TO_HERE = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BEFORE_HERE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def number_sql(c: str) -> str:
    return f"CAST(replace(replace({c}, ',', '.'), ' ', '') AS DECIMAL(28,6))"


def date_sql(c: str) -> str:
    return f"CAST(try_strptime({c}, ['%d.%m.%Y', '%m/%d/%Y']) AS DATE)"


def moment_sql(c: str) -> str:
    return f"try_strptime({c}, ['%d.%m.%Y %H:%M:%S', '%m/%d/%Y %I:%M:%S %p'])"


def fill_sql(c: str, keys: str, order: str = "row_no") -> str:
    return f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY {order} {UP_TO_HERE})"


def last_comma_sql(c: str) -> str:
    tail = f"regexp_extract({c}, '([^,]*)$', 1)"
    head = f"CASE WHEN contains({c}, ',') THEN left({c}, length({c}) - length({tail}) - 1) ELSE {c} END"
    return f"CASE WHEN {tail} <> ' ' THEN {head} || ' (ИНН: ' || {tail} || ')' ELSE left({c}, length({c}) - 2) END"


def days_sql(start: str, end: str) -> str:
    return f"unnest(generate_series(CAST({start} AS TIMESTAMP), CAST({end} AS TIMESTAMP), INTERVAL 1 DAY))"


def classified_sql(sheet: str) -> str:
    """Trial-balance rows of accounts 50 and 51, classified."""
    return f"""
classified AS (
  SELECT {FILE}, row_no, CAST(ts AS DATE) AS date,
         CASE WHEN ts IS NULL AND regexp_matches(stacked, '^[0-9]') THEN stacked END AS account,
         CASE WHEN ts IS NULL AND NOT regexp_matches(stacked, '^[0-9]') THEN stacked END AS org,
         dim AS item, receipt, payment
  FROM (SELECT *, {moment_sql('stacked')} AS ts FROM {sheet}))"""


def trial_facts_sql(where: str, name: str = "facts") -> str:
    return f"""
{name}_1 AS (SELECT * REPLACE ({fill_sql('account', 'source_file')} AS account) FROM classified),
{name}_2 AS (
  SELECT * REPLACE (CASE WHEN account IS NOT NULL THEN {fill_sql('org', 'source_file, account')} END AS org,
                    CASE WHEN account IS NOT NULL THEN {fill_sql('item', 'source_file, account')} END AS item)
  FROM {name}_1),
{name} AS (
  SELECT {FILE}, org, coalesce(item, '-') AS item, date, coalesce(sum({number_sql('receipt')}), 0) AS receipt,
         coalesce(sum({number_sql('payment')}), 0) AS payment
  FROM {name}_2 WHERE date IS NOT NULL AND org IS NOT NULL AND {where} GROUP BY ALL)"""


CASH_WHERE = "starts_with(account, '50') AND account NOT IN ('50.03', '50.23')"
BANK_WHERE = "account = '51'"

_DEBT_ITEMS = "creditor, contract, debt_type, debt_part, debt_term"


def debt_class_sql(account: str) -> str:
    def has(*codes: str) -> str:
        return "(" + " OR ".join(f"contains({account}, '{c}')" for c in codes) + ")"

    return f"""
         CASE WHEN {has('.01', '.02')} THEN 'Кредиты' WHEN {has('.03', '.04')} THEN 'Займы'
              ELSE 'Долговые ценные бумаги' END AS debt_type,
         CASE WHEN {has('.01', '.03', '.05')} THEN 'Основной долг' ELSE 'Проценты' END AS debt_part,
         CASE WHEN {has('67.')} THEN 'Долгосрочная задолженность' ELSE 'Краткосрочная задолженность' END AS debt_term"""


# Legal forms, written out here so that a slip in the library's list shows.
_FORMS = "(" + " OR ".join(
    f"contains(stacked, '{form}')"
    for form in "ИП,ООО,ОДО,АО,ЗАО,ПАО,НПАО,ХТ,ХО,ПК,ПТ ,КТ,СПК,ТОО,Колхоз,Коопхоз,ФГП,ФГУП,ОГУП,КГУП,РГУП,МУП".split(",")
) + ")"
_IS_INN = "regexp_full_match(stacked, '[0-9]{10}|[0-9]{12}')"
_IS_CODE = "regexp_full_match(stacked, '[0-9]{2}[.][0-9]{2}')"
DEBT_CLASSIFIED = f"""
classified AS (
  SELECT {FILE}, row_no, CAST(ts AS DATE) AS date,
         CASE WHEN ts IS NULL AND {_IS_CODE} THEN stacked END AS account,
         CASE WHEN ts IS NULL AND {_FORMS} THEN stacked END AS org,
         CASE WHEN ts IS NULL AND {_IS_INN} THEN coalesce(creditor, 'nan') || ' (ИНН: ' || stacked || ')' ELSE creditor END AS creditor,
         CASE WHEN ts IS NULL AND NOT {_IS_CODE} AND NOT {_IS_INN} THEN stacked END AS contract,
         receipt, payment
  FROM (SELECT *, {moment_sql('stacked')} AS ts FROM debt_sheet))"""

DEBT_FACTS = f"""{DEBT_CLASSIFIED},
d1 AS (SELECT * REPLACE ({fill_sql('account', 'source_file')} AS account) FROM classified),
d2 AS (
  SELECT * REPLACE (CASE WHEN account IS NOT NULL THEN {fill_sql('org', 'source_file, account')} END AS org,
                    CASE WHEN account IS NOT NULL THEN {fill_sql('creditor', 'source_file, account')} END AS creditor)
  FROM d1),
d3 AS (
  SELECT * REPLACE (CASE WHEN account IS NOT NULL AND creditor IS NOT NULL
                    THEN {fill_sql('contract', 'source_file, account, creditor')} END AS contract)
  FROM d2),
facts AS (
  SELECT {FILE}, org, coalesce(creditor, '-') AS creditor, contract, {debt_class_sql('account')}, date,
         coalesce(sum({number_sql('receipt')}), 0) AS receipt, coalesce(sum({number_sql('payment')}), 0) AS payment
  FROM d3 WHERE date IS NOT NULL AND org IS NOT NULL AND contract IS NOT NULL GROUP BY ALL)"""


def extend_sql(facts: str, unit: str, keys: str, zeros: str) -> str:
    """Rows of a unit's last date again at the last date of its group."""
    return f"""
  SELECT * FROM {facts}
  UNION ALL BY NAME
  SELECT {keys}, group_last AS date, {zeros}
  FROM {facts} f JOIN (SELECT {unit}, max(date) AS unit_last FROM {facts} GROUP BY ALL) USING ({unit})
       JOIN (SELECT grp, max(date) AS group_last FROM {facts} GROUP BY ALL) USING (grp)
  WHERE date = unit_last AND unit_last < group_last"""


def dense_sql(source: str, keys: str, measures: list[str]) -> str:
    values = ", ".join(f"CASE WHEN day = date THEN {m} ELSE 0 END AS {m}" for m in measures)
    return f"""
  SELECT {keys}, CAST(day AS DATE) AS date, {values}
  FROM (SELECT *, {days_sql('coalesce(prev + 1, date)', 'date')} AS day
        FROM (SELECT *, lag(date) OVER (PARTITION BY {keys} ORDER BY date) AS prev FROM {source}))"""


def seen_sql(source: str, scope: str, items: str, measures: list[str]) -> str:
    sums = ", ".join(f"sum({m}) AS {m}" for m in measures)
    zeros = ", ".join(f"0 AS {m}" for m in measures)
    return f"""
  SELECT {scope}, {items}, date, {sums}
  FROM (SELECT {scope}, {items}, date, {', '.join(measures)} FROM {source}
        UNION ALL BY NAME
        SELECT {scope}, {items}, d.date, {zeros}
        FROM (SELECT {scope}, {items}, min(date) AS first_date FROM {source} GROUP BY ALL)
             JOIN (SELECT DISTINCT {scope}, date FROM {source}) d USING ({scope})
        WHERE d.date >= first_date)
  GROUP BY ALL"""


def balance_sql(keys: str, change: str = "change") -> str:
    window = f"OVER (PARTITION BY {keys} ORDER BY date {BEFORE_HERE})"
    return f"coalesce(sum({change}) {window}, 0) AS opening, coalesce(sum({change}) {window}, 0) + {change} AS closing"


def trial_daily_sql(items: str, facts: str = "facts", name: str = "daily") -> str:
    keys = f"{FILE}, org, {items}"
    both = ["receipt", "payment"]
    return f"""
{name}_ext AS ({extend_sql(facts, 'grp, company, source_file', keys, '0 AS receipt, 0 AS payment')}),
{name}_dense AS ({dense_sql(f'{name}_ext', keys, both)}),
{name}_all AS ({seen_sql(f'{name}_dense', f'{FILE}, org', items, both)}),
{name} AS (SELECT *, {balance_sql(keys)} FROM (SELECT *, receipt - payment AS change FROM {name}_all))"""


PNL_KEYS = f"{FILE}, indicator, org, item_kind, item"


def pnl_daily_sql(facts: str = "facts", name: str = "daily") -> str:
    """Key-scope extension within (group, indicator), then dense days and balances."""
    return f"""
{name}_ext AS (
  SELECT {PNL_KEYS}, date, change FROM {facts}
  UNION ALL BY NAME
  SELECT {PNL_KEYS}, group_last AS date, 0 AS change
  FROM (SELECT {PNL_KEYS}, max(date) AS key_last FROM {facts} GROUP BY ALL)
       JOIN (SELECT grp, indicator, max(date) AS group_last FROM {facts} GROUP BY ALL) USING (grp, indicator)
  WHERE key_last < group_last),
{name}_dense AS ({dense_sql(f'{name}_ext', PNL_KEYS, ['change'])}),
{name} AS (SELECT *, {balance_sql(PNL_KEYS)} FROM {name}_dense)"""


COST_FLAT = f"""
flat AS (
  SELECT * FROM (
    SELECT {FILE}, indicator, row_no, c1 AS change,
           {fill_sql('CASE WHEN level = 0 THEN c0 END', 'source_file')} AS org,
           {fill_sql('CASE WHEN level = 3 THEN c0 END', 'source_file')} AS item_kind,
           {fill_sql('CASE WHEN level = 4 THEN c0 END', 'source_file')} AS item,
           CASE WHEN level = 5 THEN c0 END AS date
    FROM cost_sheet WHERE row_no >= 6)
  WHERE date IS NOT NULL)"""

REVENUE_FLAT = f"""
flat AS (
  SELECT * FROM (
    SELECT {FILE}, indicator, row_no, c1 AS change,
           {fill_sql('CASE WHEN level = 0 THEN c0 END', 'source_file')} AS org,
           {fill_sql('CASE WHEN level = 3 THEN c0 END', 'source_file')} AS item_kind,
           {fill_sql('CASE WHEN level = 4 THEN c0 END', 'source_file')} AS item,
           {fill_sql('CASE WHEN level = 5 THEN c0 END', 'source_file')} AS date,
           CASE WHEN level = 7 THEN c0 END AS operation
    FROM revenue_sheet WHERE row_no >= 8)
  WHERE operation IS NOT NULL)"""

DEDUCTION_FLAT = f"""
deducted AS (
  SELECT * FROM (
    SELECT grp, company, {number_sql('c1')} AS deduction,
           {fill_sql('CASE WHEN level = 0 THEN c0 END', 'source_file')} AS org,
           {fill_sql('CASE WHEN level = 3 THEN c0 END', 'source_file')} AS ded_date,
           CASE WHEN level = 5 THEN c0 END AS operation
    FROM deduction_sheet WHERE row_no >= 6)
  WHERE operation IS NOT NULL)"""


# --- parsing --------------------------------------------------------------------------------


@query("SELECT source_file, row_no, level, c0, c1 FROM events_sheet WHERE row_no >= 6", "events_sheet")
def skip_preamble(spark, sf):
    return O.skip_preamble(B.events_sheet(spark, sf), 6).drop("event_type")


@query(
    "SELECT source_file, row_no, 'G' || split_part(split_part(source_file, ')', 1), 'G', 2) AS grp, "
    "split_part(split_part(source_file, '_', -1), '.', 1) AS company FROM events_sheet",
    "events_sheet",
)
def file_identity(spark, sf):
    return O.with_file_identity(B.events_sheet(spark, sf).select("source_file", "row_no"))


@query(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS \"rows\", count({c}) AS non_null FROM events_sheet"
        for c, t in [("source_file", "string"), ("row_no", "bigint"), ("level", "int"), ("c0", "string"), ("c1", "string")]
    ),
    "events_sheet",
)
def profile_counts(spark, sf):
    return O.profile_counts(B.events_sheet(spark, sf).drop("event_type"))


@query(f"SELECT row_no, c1 AS text, {number_sql('c1')} AS amount FROM events_sheet", "events_sheet")
def parse_locale_number(spark, sf):
    sheet = B.events_sheet(spark, sf)
    return sheet.select("row_no", F.col("c1").alias("text"), X.parse_locale_number("c1").alias("amount"))


@query(
    f"SELECT row_no, CASE WHEN row_no % 9 = 0 THEN 'n/a' ELSE date END AS text, "
    f"{date_sql('CASE WHEN row_no % 9 = 0 THEN NULL ELSE date END')} AS date FROM bank_statements",
    "bank_statements",
)
def parse_multi_date(spark, sf):
    text = F.when(F.col("row_no") % 9 == 0, "n/a").otherwise(F.col("date"))
    bank = B.bank_statements(spark, sf).select("row_no", text.alias("text"))
    return bank.withColumn("date", X.parse_multi_date("text", strict=False))


@query(
    f"""SELECT source_file, row_no, 'date' AS "column", 'n/a' AS text FROM bank_statements WHERE row_no % 9 = 0
    UNION ALL SELECT source_file, row_no, 'receipt', 'x' || receipt FROM bank_statements WHERE row_no % 11 = 0 AND receipt IS NOT NULL""",
    "bank_statements",
)
def rejected_cells(spark, sf):
    """Every ninth date and every eleventh receipt is spoilt; valid and empty cells are not reported."""
    row_no = F.col("row_no")
    bank = B.bank_statements(spark, sf).select(
        "source_file",
        "row_no",
        F.when(row_no % 9 == 0, "n/a").otherwise(F.col("date")).alias("date"),
        F.when(row_no % 11 == 0, F.concat(F.lit("x"), "receipt")).otherwise(F.col("receipt")).alias("receipt"),
        "payment",
    )
    return O.rejected_cells(bank, ["source_file", "row_no"], dates=["date"], numbers=["receipt", "payment"])


@query(
    f"SELECT source_file, row_no, stacked AS text, CAST({moment_sql('stacked')} AS DATE) AS date FROM trial_sheet",
    "trial_sheet",
)
def parse_multi_datetime(spark, sf):
    sheet = B.trial_sheet(spark, sf).select("source_file", "row_no", F.col("stacked").alias("text"))
    return sheet.withColumn("date", X.parse_multi_datetime("text").cast("date"))


@query("SELECT row_no, replace(inn, '.0', '') AS inn FROM bank_statements", "bank_statements")
def clean_tax_id(spark, sf):
    return B.bank_statements(spark, sf).select("row_no", X.clean_tax_id("inn").alias("inn"))


@query(
    "SELECT row_no, CASE WHEN inn IS NULL THEN counterparty "
    "ELSE coalesce(counterparty, 'nan') || ' (ИНН: ' || inn || ')' END AS counterparty FROM bank_statements",
    "bank_statements",
)
def label_with_id(spark, sf):
    return B.bank_statements(spark, sf).select("row_no", X.label_with_id("counterparty", "inn").alias("counterparty"))


_COMMA_CASES = (
    "CASE o_custkey % 5 WHEN 0 THEN c_name || ', ' WHEN 1 THEN c_name WHEN 2 THEN '-' "
    "WHEN 3 THEN c_name || ', ' || o_custkey ELSE c_name || ',' || o_custkey END"
)


@query(f"SELECT o_orderkey, text, {last_comma_sql('text')} AS label FROM (SELECT o_orderkey, {_COMMA_CASES} AS text FROM sales)")
def split_last_comma(spark, sf):
    texts = B.sales(spark, sf).select("o_orderkey", F.expr(_COMMA_CASES).alias("text"))
    return texts.withColumn("label", X.split_last_comma("text"))


@query(
    f"SELECT row_no, CASE WHEN receipt IS NULL THEN '{L.PAYMENT}' ELSE '{L.RECEIPT}' END AS flow_type FROM bank_statements",
    "bank_statements",
)
def flow_type(spark, sf):
    return B.bank_statements(spark, sf).select("row_no", X.flow_type("receipt").alias("flow_type"))


@query(
    f"SELECT source_file, row_no, stacked AS account, {debt_class_sql('stacked')} FROM debt_sheet WHERE {_IS_CODE}",
    "debt_sheet",
)
def classify_debt(spark, sf):
    sheet = B.debt_sheet(spark, sf).where(F.rlike("stacked", F.lit(r"^[0-9]{2}\.[0-9]{2}$")))
    rows = sheet.select("source_file", "row_no", F.col("stacked").alias("account"))
    return rows.withColumns(X.classify_debt("account"))


# --- report shapes --------------------------------------------------------------------------


@query(f"{COST_FLAT} => SELECT * FROM flat", "cost_sheet")
def outline_flatten(spark, sf):
    return O.outline_flatten(O.skip_preamble(B.cost_sheet(spark, sf), 6), R.COST_OUTLINE.levels, "date")


@query(f"{REVENUE_FLAT} => SELECT * FROM flat", "revenue_sheet")
def outline_flatten_deep(spark, sf):
    return O.outline_flatten(O.skip_preamble(B.revenue_sheet(spark, sf), 8), R.REVENUE_OUTLINE.levels, "operation")


@query(f"{classified_sql('trial_sheet')} => SELECT source_file, row_no, date, account, org FROM classified", "trial_sheet")
def stacked_classify(spark, sf):
    rows = O.classify_stacked(B.trial_sheet(spark, sf), X.cash_bank_rules)
    return rows.select("source_file", "row_no", "date", "account", "org")


@query(
    f"{DEBT_CLASSIFIED} => SELECT source_file, row_no, date, account, org, creditor, contract FROM classified",
    "debt_sheet",
)
def stacked_classify_debt(spark, sf):
    rows = O.classify_stacked(B.debt_sheet(spark, sf), X.debt_rules, "creditor")
    return rows.select("source_file", "row_no", "date", "account", "org", "creditor", "contract")


@query(f"SELECT event_type, row_no, {fill_sql('c0', 'event_type')} AS c0 FROM events_sheet", "events_sheet")
def ffill_global(spark, sf):
    sheet = B.events_sheet(spark, sf).select("event_type", "row_no", "c0")
    return O.forward_fill(sheet, ["c0"], source=["event_type"], block_rows=512)


@query(
    "keyed AS (SELECT event_type, row_no, CASE WHEN level <> 5 THEN level END AS level, c0 FROM events_sheet)"
    f" => SELECT event_type, row_no, level, CASE WHEN level IS NOT NULL THEN {fill_sql('c0', 'event_type, level')} END AS c0 FROM keyed",
    "events_sheet",
)
def ffill_within_key(spark, sf):
    level = F.when(F.col("level") != 5, F.col("level"))
    sheet = B.events_sheet(spark, sf).select("event_type", "row_no", level.alias("level"), "c0")
    return O.forward_fill(sheet, ["c0"], source=["event_type"], within=["level"], block_rows=512)


# --- filters, defaults, unions --------------------------------------------------------------


@query(
    f"SELECT source_file, row_no, stacked AS account FROM trial_sheet WHERE {CASH_WHERE.replace('account', 'stacked')}",
    "trial_sheet",
)
def account_prefix_filter(spark, sf):
    sheet = B.trial_sheet(spark, sf).select("source_file", "row_no", F.col("stacked").alias("account"))
    return O.filter_account(sheet, **R.CASH_DESK.account)


@query("SELECT source_file, row_no, stacked AS account FROM trial_sheet WHERE stacked = '51'", "trial_sheet")
def account_equals_filter(spark, sf):
    sheet = B.trial_sheet(spark, sf).select("source_file", "row_no", F.col("stacked").alias("account"))
    return O.filter_account(sheet, **R.BANK_ACCOUNTS.account)


_TRIAL_SPLIT = f"{classified_sql('trial_sheet')}, {trial_facts_sql(CASH_WHERE)}"


def _desk_facts(spark, sf):
    return R.cash_desk_facts(B.trial_sheet(spark, sf), Staging(spark))


@query(
    f"{_TRIAL_SPLIT} => SELECT {FILE}, org, item AS cf_item, date, receipt, payment FROM facts "
    "WHERE receipt <> 0 OR payment <> 0",
    "trial_sheet",
)
def nonzero_movements(spark, sf):
    return O.nonzero_movements(_desk_facts(spark, sf))


_TWO_SIDES = f"""
sides AS (
  SELECT {FILE}, org, item AS cf_item, date, '{L.RECEIPT}' AS flow_type, receipt, 0 AS payment FROM facts WHERE receipt <> 0
  UNION ALL
  SELECT {FILE}, org, item, date, '{L.PAYMENT}', 0, payment FROM facts WHERE payment <> 0)"""


@query(f"{_TRIAL_SPLIT}, {_TWO_SIDES} => SELECT * FROM sides", "trial_sheet")
def split_two_way(spark, sf):
    return O.split_two_way(O.nonzero_movements(_desk_facts(spark, sf)))


_BANK_PARSED = f"""
bank AS (
  SELECT {FILE}, row_no, {date_sql('date')} AS date, {number_sql('receipt')} AS receipt, {number_sql('payment')} AS payment,
         purpose, CASE WHEN inn IS NULL THEN counterparty
                  ELSE coalesce(counterparty, 'nan') || ' (ИНН: ' || replace(inn, '.0', '') || ')' END AS counterparty,
         op_type, bank_account, org, CASE WHEN receipt IS NULL THEN '{L.PAYMENT}' ELSE '{L.RECEIPT}' END AS flow_type
  FROM bank_statements)"""


@query(
    f"""{_BANK_PARSED} => SELECT source_file, row_no, flow_type,
    CASE WHEN flow_type = '{L.RECEIPT}' THEN coalesce(receipt, 0) + coalesce(payment, 0)
         ELSE -(coalesce(receipt, 0) + coalesce(payment, 0)) END AS net_flow,
    CASE WHEN flow_type = '{L.RECEIPT}' THEN coalesce(receipt, 0) + coalesce(payment, 0) END AS inflow,
    CASE WHEN flow_type = '{L.PAYMENT}' THEN coalesce(receipt, 0) + coalesce(payment, 0) END AS outflow FROM bank""",
    "bank_statements",
)
def signed_flows(spark, sf):
    flows = O.signed_flows(R.bank_rows(B.bank_statements(spark, sf)))
    return flows.select("source_file", "row_no", "flow_type", "net_flow", "inflow", "outflow")


@query(
    f"""SELECT row_no, CASE WHEN row_no % 4 = 0 THEN '{L.CASH}' ELSE '{L.BANK}' END AS origin,
    CASE WHEN row_no % 4 = 0 THEN '{L.CASH}' ELSE coalesce(purpose, '-') END AS purpose,
    CASE WHEN row_no % 4 = 0 THEN '{L.CASH}' ELSE coalesce(counterparty, '-') END AS counterparty,
    CASE WHEN row_no % 4 = 0 THEN '{L.CASH}' ELSE coalesce(op_type, '-') END AS op_type FROM bank_statements""",
    "bank_statements",
)
def fill_defaults(spark, sf):
    origin = F.when(F.col("row_no") % 4 == 0, L.CASH).otherwise(L.BANK)
    cols = ["purpose", "counterparty", "op_type"]
    rows = B.bank_statements(spark, sf).select("row_no", origin.alias("origin"), *cols)
    return O.fill_defaults(O.override_cash(rows, cols), dict.fromkeys(cols, L.MISSING_TEXT))


_RECODED = "CASE item_group " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in L.ITEM_GROUPS.items()) + " ELSE item_group END"


@query(f"SELECT * REPLACE ({_RECODED} AS item_group) FROM dictionary", "dictionary")
def recode_values(spark, sf):
    return O.recode(B.dictionary(spark, sf), "item_group", L.ITEM_GROUPS)


@query(
    f"{classified_sql('trial_sheet')}, {trial_facts_sql(CASH_WHERE, 'f50')}, {trial_facts_sql(BANK_WHERE, 'f51')},"
    f"{trial_daily_sql('item', 'f50', 'day50')}, {trial_daily_sql('item', 'f51', 'day51')}"
    f" => SELECT {FILE}, org, item AS cf_item, NULL AS bank_account, date, receipt, payment, change, opening, closing, '{L.CASH}' AS origin FROM day50"
    f" UNION ALL SELECT {FILE}, org, NULL, item, date, receipt, payment, change, opening, closing, '{L.BANK}' FROM day51",
    "trial_sheet",
)
def union_with_origin(spark, sf):
    return R.cash_and_bank_daily(B.trial_sheet(spark, sf), Staging(spark))


@query("SELECT indicator, org, item, date, change FROM components", "components")
def pnl_union(spark, sf):
    rows = B.components(spark, sf).select("indicator", "org", "item", "date", "change")
    return O.union_components(*[rows.where(F.col("indicator") == name) for name in L.COMPONENTS])


# --- lookups --------------------------------------------------------------------------------

_MATCH = "b.grp = d.grp AND b.company = d.company AND b.flow_type = d.direction"


@query(
    f"""{_BANK_PARSED} => SELECT b.row_no, b.flow_type, b.op_type, d.cf_item, d.movement_kind, d.item_group,
    coalesce(d.row_no, -1) AS dict_row_no
    FROM bank b LEFT JOIN dictionary d ON {_MATCH} AND b.op_type IS NOT DISTINCT FROM d.op_type""",
    "bank_statements",
    "dictionary",
)
def dict_map_bank(spark, sf):
    entry = ["cf_item", "movement_kind", "item_group"]
    rows = O.map_dictionary(R.bank_rows(B.bank_statements(spark, sf)), B.dictionary(spark, sf), "op_type", entry)
    return rows.select("row_no", "flow_type", "op_type", *entry, "dict_row_no")


_FIRST_ENTRY = """
first_entry AS (
  SELECT * FROM dictionary
  QUALIFY row_number() OVER (PARTITION BY grp, company, direction, cf_item ORDER BY row_no) = 1)"""


@query(
    f"""{_TRIAL_SPLIT}, {_TWO_SIDES}, {_FIRST_ENTRY} => SELECT b.*, d.movement_kind, d.item_group,
    coalesce(d.row_no, -1) AS dict_row_no FROM sides b LEFT JOIN first_entry d ON {_MATCH} AND b.cf_item = d.cf_item""",
    "trial_sheet",
    "dictionary",
)
def dict_map_dedup(spark, sf):
    desk = O.split_two_way(O.nonzero_movements(_desk_facts(spark, sf)))
    return O.map_dictionary(
        desk, B.dictionary(spark, sf), "cf_item", ["movement_kind", "item_group"], first_only=True
    )


@query(
    """lines AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS taken, count(*) AS n FROM lineitem GROUP BY ALL)
    => SELECT o_orderkey AS operation, o_orderpriority, CAST(o_orderdate AS DATE) AS date,
    coalesce(n, 1) * CAST(o_totalprice AS DECIMAL(18,2)) - coalesce(taken, 0) AS change
    FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey"""
)
def net_of_deductions(spark, sf):
    orders = B.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("operation"),
        "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").cast(B.MONEY).alias("change"),
    )
    lines = B.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("operation"), F.col("l_extendedprice").cast(B.MONEY).alias("change")
    )
    return O.net_of(orders, lines, ["operation"]).select("operation", "o_orderpriority", "date", "change")


@query(
    f"""{_BANK_PARSED},
    firsts AS (SELECT source_file, row_no FROM bank WHERE counterparty IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY grp, company, org, counterparty ORDER BY date, source_file, row_no) = 1)
    => SELECT b.source_file, b.row_no, CASE WHEN f.row_no IS NOT NULL THEN 'Да' ELSE 'Нет' END AS is_new_counterparty
    FROM bank b LEFT JOIN firsts f ON b.source_file = f.source_file AND b.row_no = f.row_no""",
    "bank_statements",
)
def first_seen_flag(spark, sf):
    bank = R.bank_rows(B.bank_statements(spark, sf))
    flagged = O.flag_first_seen(bank, ["grp", "company", "org", "counterparty"], ["date", "source_file", "row_no"])
    return flagged.select("source_file", "row_no", "is_new_counterparty")


# --- sums and dates -------------------------------------------------------------------------

_ITEM = f"{FILE}, org, item"
FLOWS = f"""
flows AS (
  SELECT {_ITEM}, date, coalesce(sum(receipt), 0) AS receipt, coalesce(sum(payment), 0) AS payment
  FROM moves GROUP BY ALL)"""
ITEM_KEYS = [*R.FILE, "org", "item"]
BOTH = ["receipt", "payment"]


def _flows(spark, sf):
    return O.ledger_sum(B.moves(spark, sf), [*ITEM_KEYS, "date"], BOTH)


@query(f"{FLOWS} => SELECT * FROM flows", "moves")
def ledger_group_sum(spark, sf):
    return _flows(spark, sf)


@query(f"{DEBT_FACTS} => SELECT * FROM facts", "debt_sheet")
def debt_group_sum(spark, sf):
    return R.debt_facts(B.debt_sheet(spark, sf), Staging(spark))


@query("SELECT grp, max(date) AS last_date FROM moves GROUP BY ALL", "moves")
def group_last_date(spark, sf):
    return O.last_date(B.moves(spark, sf), ["grp"])


@query("SELECT grp, org, item, max(date) AS last_date FROM moves GROUP BY ALL", "moves")
def key_last_date(spark, sf):
    return O.last_date(B.moves(spark, sf), ["grp", "org", "item"])


@query("SELECT DISTINCT grp, org, date, item FROM moves", "moves")
def distinct_items_per_day(spark, sf):
    return O.distinct_items_per_day(B.moves(spark, sf), ["grp", "org"], ["item"])


@query(
    f"{FLOWS} => SELECT *, date_diff('day', lag(date) OVER (PARTITION BY {_ITEM} ORDER BY date), date) AS gap_days FROM flows",
    "moves",
)
def date_gap(spark, sf):
    return O.date_gap(_flows(spark, sf), ITEM_KEYS)


@query(f"{FLOWS} => {dense_sql('flows', _ITEM, BOTH)}", "moves")
def densify_calendar(spark, sf):
    return O.densify_calendar(_flows(spark, sf), ITEM_KEYS, BOTH)


@query(f"{FLOWS} => {extend_sql('flows', 'grp, company, source_file', _ITEM, '0 AS receipt, 0 AS payment')}", "moves")
def extend_last_file(spark, sf):
    return O.extend_to_group_end(_flows(spark, sf), ["grp"], R.FILE, BOTH)


@query(f"{FLOWS} => {extend_sql('flows', _ITEM, _ITEM, '0 AS receipt, 0 AS payment')}", "moves")
def extend_last_key(spark, sf):
    return O.extend_to_group_end(_flows(spark, sf), ["grp"], ITEM_KEYS, BOTH)


@query(f"{FLOWS} => {seen_sql('flows', f'{FILE}, org', 'item', BOTH)}", "moves")
def seen_so_far(spark, sf):
    return O.expand_seen_so_far(_flows(spark, sf), [*R.FILE, "org"], ["item"], BOTH)


@query(f"{FLOWS} => SELECT *, {balance_sql(_ITEM)} FROM (SELECT *, receipt - payment AS change FROM flows)", "moves")
def running_balance(spark, sf):
    flows = _flows(spark, sf).withColumn("change", F.col("receipt") - F.col("payment"))
    return O.running_balance(flows, ITEM_KEYS)


@query(f"{FLOWS}, {trial_daily_sql('item', 'flows')} => SELECT * FROM daily", "moves")
def daily_balance(spark, sf):
    return R.balances_by_day(_flows(spark, sf), ["item"])


# --- profit lines ---------------------------------------------------------------------------

COMPONENT_FACTS = f"""
facts AS (SELECT {PNL_KEYS}, date, sum(change) AS change FROM components GROUP BY ALL)"""


def _component_facts(spark, sf):
    return O.ledger_sum(B.components(spark, sf), [*R.COMPONENT_KEYS, "date"], ["change"])


@query("SELECT grp, indicator, org, date, sum(change) AS change FROM components GROUP BY ALL", "components")
def profit_base(spark, sf):
    return O.profit_base(B.components(spark, sf))


# Indicators and profit lines, written out here so that a slip in the library's tables shows.
_INDICATORS = {
    "revenue": "Выручка",
    "cost_of_sales": "Себестоимость продаж",
    "commercial_costs": "Коммерческие расходы",
    "administrative_costs": "Управленческие расходы",
    "other_income": "Прочие доходы",
    "other_costs": "Прочие расходы",
    "income_tax": "Налог на прибыль",
}
_PROFITS = {
    "gross_profit": "Валовая прибыль (убыток)",
    "sales_profit": "Прибыль (убыток) от продаж",
    "pre_tax_profit": "Прибыль (убыток) до налогообложения",
    "net_profit": "Чистая прибыль (убыток)",
}
_PIVOT_SUMS = ", ".join(
    f"coalesce(sum(CASE WHEN indicator = '{label}' THEN change END), 0) AS {column}" for column, label in _INDICATORS.items()
)
_PIVOT = f"""
pivoted AS (SELECT grp, org, date, {_PIVOT_SUMS} FROM components GROUP BY ALL),
spread AS (
  SELECT grp, org, date, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _INDICATORS)}
  FROM (SELECT DISTINCT grp, org FROM pivoted) JOIN (SELECT DISTINCT grp, date FROM pivoted) USING (grp)
       LEFT JOIN pivoted USING (grp, org, date)),
cascade AS (
  SELECT *, revenue + cost_of_sales AS gross_profit,
         revenue + cost_of_sales + commercial_costs + administrative_costs AS sales_profit,
         revenue + cost_of_sales + commercial_costs + administrative_costs + other_income + other_costs AS pre_tax_profit,
         revenue + cost_of_sales + commercial_costs + administrative_costs + other_income + other_costs + income_tax AS net_profit
  FROM spread)"""
_UNPIVOT = "\nUNION ALL ".join(
    f"SELECT grp, org, date, '{label}' AS indicator, {column} AS change FROM cascade"
    for column, label in _PROFITS.items()
)


def _cascade(spark, sf):
    return O.profit_cascade(O.spread_to_group_dates(O.pivot_indicators(B.components(spark, sf))))


@query(f"{_PIVOT} => SELECT * FROM spread", "components")
def profit_pivot(spark, sf):
    return O.spread_to_group_dates(O.pivot_indicators(B.components(spark, sf)))


@query(f"{_PIVOT} => SELECT * FROM cascade", "components")
def profit_cascade(spark, sf):
    return _cascade(spark, sf)


@query(f"{_PIVOT} => {_UNPIVOT}", "components")
def profit_unpivot(spark, sf):
    return O.profit_unpivot(_cascade(spark, sf))


_CARRIED = f"""
carried AS (
  SELECT {PNL_KEYS}, date, change, opening, closing FROM daily
  UNION ALL BY NAME
  SELECT {PNL_KEYS}, CAST(day AS DATE) AS date, 0 AS change, closing AS opening, closing
  FROM (SELECT d.*, {days_sql('date + 1', 'group_last')} AS day
        FROM daily d JOIN (SELECT grp, org, indicator, max(date) AS own_last FROM daily GROUP BY ALL) USING (grp, org, indicator)
             JOIN (SELECT grp, max(date) AS group_last FROM daily GROUP BY ALL) USING (grp)
        WHERE date = own_last AND own_last < group_last))"""


@query(f"{COMPONENT_FACTS}, {pnl_daily_sql()}, {_CARRIED} => SELECT * FROM carried", "components")
def carry_forward_indicator(spark, sf):
    daily = R.components_by_day(_component_facts(spark, sf))
    return O.carry_forward_rows(daily, ["grp"], ["org", "indicator"])


_LINES = f"""
{_PIVOT.replace('FROM components', 'FROM carried')},
lines AS ({_UNPIVOT}),
line_balances AS (SELECT *, {balance_sql('grp, org, indicator')} FROM lines)"""
_STATEMENT = f"{COMPONENT_FACTS}, {pnl_daily_sql()}, {_CARRIED}, {_LINES}"


@query(f"{_STATEMENT} => SELECT * FROM line_balances", "components")
def profit_running(spark, sf):
    facts = _component_facts(spark, sf)
    bounds = facts.groupBy("grp").agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    return O.profit_lines(facts, bounds)


@query(
    f"{_STATEMENT} => SELECT grp, org, item_kind, item, indicator, date, change, opening, closing FROM carried"
    " UNION ALL SELECT grp, org, '-', '-', indicator, date, change, opening, closing FROM line_balances",
    "components",
)
def statement_from_facts(spark, sf):
    return R.statement_from_facts(_component_facts(spark, sf)).drop("company", "source_file")


# --- reports --------------------------------------------------------------------------------

_COST_FACTS = f"""{COST_FLAT},
facts AS (
  SELECT {FILE}, indicator, org, item_kind, {last_comma_sql("coalesce(item, '-')")} AS item, {date_sql('date')} AS date,
         -sum({number_sql('change')}) AS change
  FROM flat WHERE org IS NOT NULL AND item_kind IS NOT NULL GROUP BY ALL)"""


@query(f"{_COST_FACTS}, {pnl_daily_sql()} => SELECT * FROM daily", "cost_sheet")
def pnl_component(spark, sf):
    return R.pnl_component(B.cost_sheet(spark, sf), stage=Staging(spark))


_REVENUE_FACTS = f"""{REVENUE_FLAT}, {DEDUCTION_FLAT},
netted AS (
  SELECT {FILE}, indicator, org, item_kind, item, {date_sql('date')} AS date,
         {number_sql('change')} - coalesce(deduction, 0) AS change
  FROM flat f LEFT JOIN (SELECT grp AS g, company AS c, org AS o, {date_sql('ded_date')} AS dd, operation AS op, deduction FROM deducted)
       ON grp = g AND company = c AND org = o AND {date_sql('date')} = dd AND operation = op),
facts AS (
  SELECT {FILE}, indicator, org, item_kind, {last_comma_sql("coalesce(item, '-')")} AS item, date, sum(change) AS change
  FROM netted WHERE org IS NOT NULL AND item_kind IS NOT NULL GROUP BY ALL)"""


@query(f"{_REVENUE_FACTS}, {pnl_daily_sql()} => SELECT * FROM daily", "revenue_sheet", "deduction_sheet")
def pnl_revenue_net(spark, sf):
    return R.pnl_component(B.revenue_sheet(spark, sf), R.REVENUE_OUTLINE, B.deduction_sheet(spark, sf), Staging(spark))


_ITEM_OF_COSTS = (
    f"CASE WHEN indicator = 'Себестоимость продаж' THEN {last_comma_sql("coalesce(item, '-')")} ELSE coalesce(item, '-') END"
)
_STATEMENT_SHEETS = f"""{_REVENUE_FACTS.replace('facts AS (', 'revenue_facts AS (')},
{COST_FLAT.replace('flat AS (', 'cost_flat AS (').replace('FROM cost_sheet', 'FROM costs_sheet')},
facts AS (
  SELECT * FROM revenue_facts
  UNION ALL BY NAME
  SELECT {FILE}, indicator, org, item_kind, {_ITEM_OF_COSTS} AS item, {date_sql('date')} AS date,
         sum(CASE WHEN indicator = 'Прочие доходы' THEN {number_sql('change')} ELSE -{number_sql('change')} END) AS change
  FROM cost_flat WHERE org IS NOT NULL AND item_kind IS NOT NULL GROUP BY ALL),
{pnl_daily_sql()}, {_CARRIED}, {_LINES}"""


@query(
    f"{_STATEMENT_SHEETS} => SELECT grp, org, item_kind, item, indicator, date, change, opening, closing FROM carried"
    " UNION ALL SELECT grp, org, '-', '-', indicator, date, change, opening, closing FROM line_balances",
    "revenue_sheet",
    "deduction_sheet",
    "costs_sheet",
)
def pnl_statement(spark, sf):
    """From the sheets of revenue, deductions and the six cost, income and tax reports."""
    revenue, deductions = B.revenue_sheet(spark, sf), B.deduction_sheet(spark, sf)
    return R.pnl_statement(revenue, deductions, B.costs_sheet(spark, sf), Staging(spark)).drop("company", "source_file")


def _trial_report(where: str, item: str) -> str:
    return (
        f"{classified_sql('trial_sheet')}, {trial_facts_sql(where)}, {trial_daily_sql('item')}"
        f" => SELECT {FILE}, org, item AS {item}, date, receipt, payment, change, opening, closing FROM daily"
    )


@query(_trial_report(CASH_WHERE, "cf_item"), "trial_sheet")
def osv_cash_daily(spark, sf):
    return R.trial_balance_daily(B.trial_sheet(spark, sf), R.CASH_DESK, Staging(spark))


@query(_trial_report(BANK_WHERE, "bank_account"), "trial_sheet")
def osv_bank_daily(spark, sf):
    return R.trial_balance_daily(B.trial_sheet(spark, sf), R.BANK_ACCOUNTS, Staging(spark))


@query(f"{DEBT_FACTS}, {trial_daily_sql(_DEBT_ITEMS)} => SELECT * FROM daily", "debt_sheet")
def debt_daily(spark, sf):
    return R.debt_daily(B.debt_sheet(spark, sf), Staging(spark))


@query(
    f"""{_BANK_PARSED}, {_TRIAL_SPLIT}, {_TWO_SIDES}, {_FIRST_ENTRY},
flows AS (
  SELECT b.grp, b.company, b.org, b.date, coalesce(b.purpose, '-') AS purpose, coalesce(b.counterparty, '-') AS counterparty,
         coalesce(b.op_type, '-') AS op_type, coalesce(b.bank_account, '-') AS bank_account, b.flow_type,
         coalesce(b.receipt, 0) + coalesce(b.payment, 0) AS amount, d.cf_item, d.movement_kind, d.item_group,
         '{L.BANK}' AS origin, b.row_no, coalesce(d.row_no, -1) AS dict_row, b.source_file
  FROM bank b LEFT JOIN dictionary d ON {_MATCH} AND b.op_type IS NOT DISTINCT FROM d.op_type
  UNION ALL
  SELECT b.grp, b.company, b.org, b.date, '{L.CASH}', '{L.CASH}', '{L.CASH}', '{L.CASH}', b.flow_type,
         b.receipt + b.payment, b.cf_item, d.movement_kind, d.item_group, '{L.CASH}', -1, coalesce(d.row_no, -1), ''
  FROM sides b LEFT JOIN first_entry d ON {_MATCH} AND b.cf_item = d.cf_item),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY grp, company, org, counterparty
    ORDER BY date, origin = '{L.CASH}', flow_type = '{L.PAYMENT}', source_file, row_no, dict_row, coalesce(cf_item, '-')) AS rn
  FROM flows)
=> SELECT grp, company, date, purpose, counterparty, op_type, bank_account, org, flow_type,
     coalesce(cf_item, '-') AS cf_item, coalesce(movement_kind, '-') AS movement_kind,
     coalesce({_RECODED}, '{L.UNMAPPED_GROUP}') AS item_group, origin,
     CASE WHEN flow_type = '{L.RECEIPT}' THEN amount ELSE -amount END AS net_flow,
     CASE WHEN flow_type = '{L.RECEIPT}' THEN amount END AS inflow,
     CASE WHEN flow_type = '{L.PAYMENT}' THEN amount END AS outflow,
     CASE WHEN rn = 1 THEN '{L.YES}' ELSE '{L.NO}' END AS is_new_counterparty
FROM ranked""",
    "bank_statements",
    "trial_sheet",
    "dictionary",
)
def cash_flow(spark, sf):
    return R.cash_flow(B.bank_statements(spark, sf), B.dictionary(spark, sf), B.trial_sheet(spark, sf), Staging(spark))


# The headers of this report, written out here so that a slip in the library's table shows.
_PUBLISHED = (
    'org AS "Организация", cf_item AS "Статья движения денежных средств", date AS "Дата", round(opening, 2) AS "Начальный остаток", '
    'round(receipt, 2) AS "Поступление", round(payment, 2) AS "Списание", round(closing, 2) AS "Конечный остаток", round(change, 2) AS "Изменение"'
)


@query(
    f"{FLOWS}, {trial_daily_sql('item', 'flows')}, named AS (SELECT *, item AS cf_item FROM daily)"
    f" => SELECT grp, {_PUBLISHED} FROM named",
    "moves",
)
def report_round_trip(spark, sf):
    """Daily balances written as CSV by group and read back."""
    daily = R.balances_by_day(_flows(spark, sf), ["item"]).withColumnRenamed("item", "cf_item")
    folder = Staging(spark).folder()
    write_report(daily, folder, "ОСВ 50")
    return spark.read.schema(published(daily, "ОСВ 50").schema).option("header", True).csv(f"{folder}/ОСВ 50")


_KEPT = """
  grp NOT IN (SELECT min(grp) FROM moves)"""


@query(
    f"{FLOWS}, {trial_daily_sql('item', 'flows')}, named AS (SELECT *, item AS cf_item FROM daily)"
    f" => SELECT grp, {_PUBLISHED} FROM named WHERE {_KEPT}",
    "moves",
)
def published_groups(spark, sf):
    """Daily balances published for all groups, then anew for the first group, which has no rows any more."""
    daily = R.balances_by_day(_flows(spark, sf), ["item"]).withColumnRenamed("item", "cf_item")
    out = Staging(spark).folder()
    first = daily.agg(F.min("grp")).first()[0]
    with Publication(spark, out) as publication:
        publication.write(daily, "ОСВ 50")
    with Publication(spark, out) as publication:
        publication.write(daily.where(F.col("grp") != first), "ОСВ 50", [first])
    return spark.read.schema(published(daily, "ОСВ 50").schema).option("header", True).csv(f"{out}/ОСВ 50")


@query(
    f"""{FLOWS}, {trial_daily_sql('item', 'flows')}, shown AS (SELECT {_PUBLISHED}, grp FROM daily JOIN (SELECT DISTINCT item AS cf_item FROM daily) ON item = cf_item)
    => SELECT "column", rows, non_null FROM (
      SELECT unnest(['Организация', 'Статья движения денежных средств', 'Дата', 'Начальный остаток', 'Поступление', 'Списание',
                     'Конечный остаток', 'Изменение', 'grp']) AS "column",
             count(*) AS rows,
             unnest([count("Организация"), count("Статья движения денежных средств"), count("Дата"), count("Начальный остаток"),
                     count("Поступление"), count("Списание"), count("Конечный остаток"), count("Изменение"), count(grp)]) AS non_null
      FROM shown)""",
    "moves",
)
def report_profile(spark, sf):
    """The profile of a published report, counted by its write."""
    daily = R.balances_by_day(_flows(spark, sf), ["item"]).withColumnRenamed("item", "cf_item")
    with Publication(spark, Staging(spark).folder()) as publication:
        publication.write(daily, "ОСВ 50")
    profile = [(column, rows, non_null) for column, _, rows, non_null in publication.profiles["ОСВ 50"]]
    return spark.createDataFrame(profile, "column string, rows long, non_null long")


@query(f"{FLOWS}, {trial_daily_sql('item', 'flows')} => SELECT * FROM daily", "moves")
def incremental_balance(spark, sf):
    """Balances kept over three updates: half of the sources, the others, and corrected versions of all of them.

    The first versions have other amounts on the later days and lack every third item there.
    """
    flows = _flows(spark, sf)
    store = BalanceStore(spark, Staging(spark).folder(), flows.schema, ["item"])
    middle = flows.agg(F.expr("min(date) + CAST(date_diff(max(date), min(date)) / 2 AS INT)").alias("d")).first()["d"]
    late = F.col("date") > F.lit(middle)
    early = flows.where(~late | (F.pmod(F.hash("item"), F.lit(3)) != 0))
    early = early.withColumn("receipt", F.when(late, F.col("receipt") + 1).otherwise(F.col("receipt")).cast(flows.schema["receipt"].dataType))
    one_half = F.pmod(F.hash("source_file"), F.lit(2)) == 0
    store.update(early.where(one_half))
    store.update(early.where(~one_half))
    store.update(flows)
    return store.daily()


_PAGE_FILES = """
page_files AS (
  SELECT 'file:/landing/' || page_id || '/(Г)Отчёт_' || (page_id % 7) || '.xlsx' AS path,
         '(Г)Отчёт_' || (page_id % 7) || '.xlsx' AS name, substr(html, 1, CAST(page_id % 2 AS INTEGER) + 1) AS content
  FROM pages WHERE html IS NOT NULL)"""


@query(
    f"""{_PAGE_FILES} => SELECT path, name || '@' || substr(sha256(content), 1, 32) AS source_file FROM page_files
    QUALIFY dense_rank() OVER (PARTITION BY name, content ORDER BY path) = 1"""
)
def workbook_identity(spark, sf):
    """Files of few names and contents in many folders: a content counts once for each name, under its smallest path."""
    page_id = F.col("page_id")
    name = F.concat(F.lit("(Г)Отчёт_"), page_id % 7, F.lit(".xlsx"))
    content = F.substring("html", F.lit(1), (page_id % 2 + 1).cast("int")).cast("binary")
    files = spark.read.parquet(f"{sf}/pages.parquet").where("html IS NOT NULL").select(
        F.concat(F.lit("file:/landing/"), page_id, F.lit("/"), name).alias("path"), F.octet_length(content).cast("long").alias("length"), content.alias("content")
    )
    kept = files.withColumn("id", W.identity(W.file_name("path"))).join(
        W.repeated(files).distinct().withColumnRenamed("path", "again"), F.col("path") == F.col("again"), "left_anti"
    )
    return kept.select("path", F.col("id").alias("source_file"))


_SPOILT = """
spoilt AS (SELECT * REPLACE (CASE WHEN row_no % 7 = 3 AND receipt IS NOT NULL THEN receipt || '?' ELSE receipt END AS receipt) FROM trial_sheet),
readable AS (SELECT * FROM spoilt WHERE receipt IS NULL OR NOT contains(receipt, '?') OR {moment} IS NULL)""".replace("{moment}", moment_sql("stacked"))


def _spoilt(spark, sf):
    receipt = F.when((F.col("row_no") % 7 == 3) & F.col("receipt").isNotNull(), F.concat("receipt", F.lit("?"))).otherwise(F.col("receipt"))
    return B.trial_sheet(spark, sf).withColumn("receipt", receipt)


@query(
    f"{_SPOILT}, {classified_sql('readable')}, {trial_facts_sql(CASH_WHERE)}, {trial_daily_sql('item')}"
    f" => SELECT {FILE}, org, item AS cf_item, date, receipt, payment, change, opening, closing FROM daily",
    "trial_sheet",
)
def report_without_rejects(spark, sf):
    """A report over a sheet with spoilt cells: their rows take no part."""
    return R.trial_balance_daily(_spoilt(spark, sf), R.CASH_DESK, Staging(spark), R.Rejects())


@query(
    f"{_SPOILT} => SELECT {FILE}, row_no, 'receipt' AS \"column\", receipt AS text FROM spoilt"
    f" WHERE row_no >= 4 AND contains(receipt, '?') AND {moment_sql('stacked')} IS NOT NULL",
    "trial_sheet",
)
def report_rejects(spark, sf):
    """The spoilt cells of the same sheet, out of the pass that reads it for the report."""
    rejects = R.Rejects()
    R.trial_balance_facts(_spoilt(spark, sf), R.BOTH, Staging(spark), rejects)
    return rejects.cells().drop("sheet")


# --- workbooks --------------------------------------------------------------------------------

TRIAL_CELLS = ["stacked", "dim", None, None, "receipt", "payment"]


@query("SELECT grp, company, row_no, stacked, dim, receipt, payment FROM trial_sheet", "trial_sheet")
def landed_trial_sheet(spark, sf):
    """A sheet with a header, out of workbooks."""
    books = workbooks(B.trial_sheet(spark, sf), TRIAL_CELLS, "file:/landing", header=True)
    return W.trial_sheet(W.decode_workbooks(books)).drop("source_file")


@query("SELECT grp, company, indicator, row_no, level, c0, c1 FROM cost_sheet", "cost_sheet")
def landed_outline(spark, sf):
    """An outline without a header, out of workbooks."""
    books = workbooks(B.cost_sheet(spark, sf), ["c0", "c1"], "file:/landing", header=False)
    return W.outline_sheet(W.decode_workbooks(books), L.COST_OF_SALES).drop("source_file")


def _drops(spark, sf, landed):
    """After each of three drops: first versions and an empty workbook, corrected ones, and the same again in another folder."""
    stage = Staging(spark)
    sheet = stage(B.trial_sheet(spark, sf))
    receipt = F.when((F.col("row_no") % 5 == 0) & F.col("receipt").isNotNull(), F.lit("1,5")).otherwise(F.col("receipt"))
    empty = sheet.where("row_no = 4").withColumns({"source_file": F.concat(F.lit("("), "grp", F.lit(")ОСВ 50-51_Пусто.xlsx")), "stacked": F.lit(None).cast("string")})
    first = sheet.withColumn("receipt", receipt).where("row_no % 11 > 0").unionByName(empty.dropDuplicates(["source_file"]))
    land(stage(workbooks(first, TRIAL_CELLS, "file:/landing/a", header=True)), landed)
    yield
    corrected = stage(workbooks(sheet, TRIAL_CELLS, "file:/landing/a", header=True, version=1))
    land(corrected, landed)
    yield
    moved = {"path": F.replace("path", F.lit("/landing/a/"), F.lit("/landing/b/")), "modificationTime": F.col("modificationTime") + F.expr("INTERVAL 1 DAY")}
    land(corrected.withColumns(moved), landed)
    yield


@query("SELECT grp, company, row_no, stacked, dim, receipt, payment FROM trial_sheet", "trial_sheet")
def landed_store(spark, sf):
    """Corrected workbooks replace what they were, a content in two folders counts once, an empty workbook has no rows."""
    landed = Staging(spark).folder()
    for _ in _drops(spark, sf, landed):
        pass
    return W.trial_sheet(landed_rows(spark, landed)).where("company <> 'Пусто'").drop("source_file")


@query(
    f"{classified_sql('trial_sheet')}, {trial_facts_sql(CASH_WHERE)}, {trial_daily_sql('item')}"
    " => SELECT grp, company, org, item, date, receipt, payment, change, opening, closing FROM daily",
    "trial_sheet",
)
def streamed_balances(spark, sf):
    """Balances kept up to date while workbooks are dropped and corrected."""
    landed, kept = Staging(spark).folder(), KeptBalances(spark, Staging(spark).folder())
    for _ in _drops(spark, sf, landed):
        kept.sync(landed)
    return kept.trial.daily().where(F.col("origin") == L.CASH).drop("origin", "source_file")
