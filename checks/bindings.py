"""Ledger-shaped inputs derived from the test tables, once in Spark and once in SQL.

Every pair below has the same name on both sides: the function returns the DataFrame, the entry in
``VIEWS`` is the SQL text of the same rows.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerspark.functions import labels as L

MONEY = "decimal(18,2)"


@cache
def schema_of(path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    return spark.read.schema(schema_of(path)).parquet(path)


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Nations with their region: the region is a company, two or three regions form a group."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey",
        "n_name",
        F.col("r_name").alias("company"),
        F.when(F.col("r_regionkey") < 2, "Альфа").otherwise("Бета").alias("grp"),
    )


def sales(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "grp",
            "company",
            "n_name",
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            F.col("o_orderdate").cast("date").alias("day"),
            "o_orderpriority",
            "o_totalprice",
            "c_name",
            "c_mktsegment",
        )
    )


def workbook(report: str) -> F.Column:
    return F.concat(F.lit("("), F.col("grp"), F.lit(f"){report}_"), F.col("company"), F.lit(".xlsx"))


def locale_text(amount: F.Column) -> F.Column:
    return F.translate(F.format_number(amount, 2), ",.", " ,")


def comma_text(amount: F.Column) -> F.Column:
    return F.replace(amount.cast(MONEY).cast("string"), F.lit("."), F.lit(","))


def date_text(day: F.Column, number: F.Column) -> F.Column:
    return F.when(number % 2 == 0, F.date_format(day, "dd.MM.yyyy")).otherwise(F.date_format(day, "M/d/yyyy"))


def moment_text(day: F.Column, number: F.Column) -> F.Column:
    even = F.concat(F.date_format(day, "dd.MM.yyyy"), F.lit(" 0:00:00"))
    return F.when(number % 2 == 0, even).otherwise(F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 12:00:00 AM")))


PLACES_SQL = """
places AS (
  SELECT n_nationkey, n_name, r_name AS company,
         CASE WHEN r_regionkey < 2 THEN 'Альфа' ELSE 'Бета' END AS grp
  FROM nation JOIN region ON n_regionkey = r_regionkey),
sales AS (
  SELECT grp, company, n_name, o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day,
         o_orderpriority, o_totalprice, c_name, c_mktsegment
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN places ON c_nationkey = n_nationkey)"""


def _workbook_sql(report: str) -> str:
    return f"'(' || grp || '){report}_' || company || '.xlsx'"


def _locale_sql(amount: str) -> str:
    return f"translate(format('{{:,.2f}}', {amount}), ',.', ' ,')"


def _comma_sql(amount: str) -> str:
    return f"replace(CAST(CAST({amount} AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"


def _date_sql(day: str, number: str) -> str:
    return f"CASE WHEN {number} % 2 = 0 THEN strftime({day}, '%d.%m.%Y') ELSE strftime({day}, '%-m/%-d/%Y') END"


def _moment_sql(day: str, number: str) -> str:
    return (
        f"CASE WHEN {number} % 2 = 0 THEN strftime({day}, '%d.%m.%Y') || ' 0:00:00' "
        f"ELSE strftime({day}, '%-m/%-d/%Y') || ' 12:00:00 AM' END"
    )


# --- tidy ledgers ---------------------------------------------------------------------------


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Dated changes per source, organisation, kind and item."""
    return sales(spark, sf).select(
        "grp",
        "company",
        workbook("Расходы").alias("source_file"),
        F.col("company").alias("org"),
        F.col("c_mktsegment").alias("item_kind"),
        F.col("o_orderpriority").alias("item"),
        F.col("day").alias("date"),
        F.col("o_totalprice").cast(MONEY).alias("change"),
    )


LEDGER_SQL = f"""
ledger AS (
  SELECT grp, company, {_workbook_sql('Расходы')} AS source_file, company AS org, c_mktsegment AS item_kind,
         o_orderpriority AS item, day AS date, CAST(o_totalprice AS DECIMAL(18,2)) AS change
  FROM sales)"""

# Where each source's ledger ends early, so that extension has work to do: company -> last date.
ENDS = {"ASIA": "2001-05-31", "AFRICA": "2001-06-30"}


def moves(spark: SparkSession, sf: str) -> DataFrame:
    """Dated receipts and payments per source, organisation and item; two sources end early."""
    line, orders, customer = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    price = F.col("l_extendedprice").cast(MONEY)
    shipped = F.col("l_shipdate").cast("date")
    date = shipped
    for company, last in ENDS.items():
        date = F.when(F.col("company") == company, F.least(shipped, F.lit(last).cast("date"))).otherwise(date)
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(places(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "grp",
            "company",
            workbook("ОСВ 50-51").alias("source_file"),
            F.concat_ws(" ", "company", "l_linestatus").alias("org"),
            F.col("o_orderpriority").alias("item"),
            date.alias("date"),
            F.when(F.col("l_returnflag") != "R", price).alias("receipt"),
            F.when(F.col("l_returnflag") == "R", price).alias("payment"),
        )
    )


_MOVES_DATE = "CASE " + " ".join(
    f"WHEN company = '{company}' THEN least(CAST(l_shipdate AS DATE), DATE '{last}')" for company, last in ENDS.items()
) + " ELSE CAST(l_shipdate AS DATE) END"

MOVES_SQL = f"""
moves AS (
  SELECT grp, company, {_workbook_sql('ОСВ 50-51')} AS source_file, company || ' ' || l_linestatus AS org,
         o_orderpriority AS item, {_MOVES_DATE} AS date,
         CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS receipt,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS payment
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN places ON c_nationkey = n_nationkey)"""


def indicator_of(number: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in L.COMPONENTS]), (number % 7 + 1).cast("int"))


_INDICATOR_SQL = "CASE o_custkey % 7 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(L.COMPONENTS)) + " END"
_NEGATED_SQL = ", ".join(
    f"'{c}'" for c in (L.COST_OF_SALES, L.COMMERCIAL_COSTS, L.ADMINISTRATIVE_COSTS, L.OTHER_COSTS, L.INCOME_TAX)
)


def components(spark: SparkSession, sf: str) -> DataFrame:
    """Signed changes of the seven indicators; other income ends early."""
    rows = sales(spark, sf).withColumn("indicator", indicator_of(F.col("o_custkey")))
    early = F.least(F.col("day"), F.lit("2000-12-31").cast("date"))
    amount = F.col("o_totalprice").cast(MONEY)
    costs = [L.COST_OF_SALES, L.COMMERCIAL_COSTS, L.ADMINISTRATIVE_COSTS, L.OTHER_COSTS, L.INCOME_TAX]
    return rows.select(
        "grp",
        "company",
        workbook("ОФР").alias("source_file"),
        "indicator",
        F.col("company").alias("org"),
        F.lit("Вид").alias("item_kind"),
        F.col("c_mktsegment").alias("item"),
        F.when(F.col("indicator") == L.OTHER_INCOME, early).otherwise(F.col("day")).alias("date"),
        F.when(F.col("indicator").isin(costs), -amount).otherwise(amount).alias("change"),
    )


COMPONENTS_SQL = f"""
labelled AS (SELECT *, {_INDICATOR_SQL} AS indicator, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM sales),
components AS (
  SELECT grp, company, {_workbook_sql('ОФР')} AS source_file, indicator, company AS org, 'Вид' AS item_kind,
         c_mktsegment AS item,
         CASE WHEN indicator = '{L.OTHER_INCOME}' THEN least(day, DATE '2000-12-31') ELSE day END AS date,
         CASE WHEN indicator IN ({_NEGATED_SQL}) THEN -amount ELSE amount END AS change
  FROM labelled)"""


# --- report sheets --------------------------------------------------------------------------


def events_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A generic outline: six levels, one source per user."""
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("(G"), F.col("user_id") % 3, F.lit(")Лист_"), F.col("user_id"), F.lit(".xlsx")).alias("source_file"),
        F.col("event_id").alias("row_no"),
        (F.col("event_id") % 6).cast("int").alias("level"),
        F.when(F.col("event_id") % 11 != 0, F.concat_ws("_", "event_type", "user_id", F.col("event_id") % 13)).alias("c0"),
        locale_text(F.col("value") * 1000).alias("c1"),
        "event_type",
    )


EVENTS_SQL = f"""
events_sheet AS (
  SELECT '(G' || (user_id % 3) || ')Лист_' || user_id || '.xlsx' AS source_file, event_id AS row_no,
         CAST(event_id % 6 AS INTEGER) AS level,
         CASE WHEN event_id % 11 <> 0 THEN event_type || '_' || user_id || '_' || (event_id % 13) END AS c0,
         {_locale_sql('value * 1000')} AS c1, event_type
  FROM events)"""


# Keys in a slice of a source. Keys are unique there, so this bounds the rows of a slice as well.
SLICE = 1 << 16


def counted(rows: DataFrame, key: F.Column, when: list[F.Column], first: int) -> DataFrame:
    """Sheet rows, several per input row: ``i`` numbers the conditions that hold.

    ``row_no`` counts the sheet rows of a source_file without gaps in the order of ``key`` and ``i``, as in a worksheet; the
    body begins at ``first``. A source is numbered in slices of its keys, each from the number of rows in the slices before.
    """
    numbers = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(when)]))
    sliced = rows.withColumns({"_key": key, "_slice": F.floor(key / SLICE), "_numbers": numbers})
    before = Window.partitionBy("source_file").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy("source_file", "_slice")
        .agg(F.sum(F.size("_numbers")).alias("_rows"))
        .select("source_file", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    own = Window.partitionBy("source_file", "_slice").orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sliced.withColumn("_end", F.sum(F.size("_numbers")).over(own)).join(starts, ["source_file", "_slice"])
    at = (F.col("_start") + F.col("_end") - F.size("_numbers") + first).cast("int")
    return (
        placed.select(*rows.columns, at.alias("_at"), F.posexplode("_numbers").alias("_pos", "i"))
        .withColumn("row_no", F.col("_at") + F.col("_pos"))
        .drop("_at", "_pos")
    )


def counted_sql(name: str, first: int) -> str:
    """The sheet ``name`` from the view ``name_rows``."""
    return (
        f"{name} AS (SELECT * REPLACE (row_number() OVER (PARTITION BY source_file ORDER BY row_no) + {first - 1} AS row_no)"
        f" FROM {name}_rows)"
    )


def case(*values: F.Column | None) -> F.Column:
    """The value at place ``i``; None stands for null."""
    chosen = F.lit(None).cast("string")
    for i, value in enumerate(values):
        if value is not None:
            chosen = F.when(F.col("i") == i, value).otherwise(chosen)
    return chosen


def trial_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Trial balance of accounts 50 and 51: up to three stacked rows per order."""
    key = F.col("o_orderkey")
    account = F.element_at(
        F.array(F.lit("50.01"), F.lit("51"), F.lit("50.03"), F.lit("50.02")), (F.floor(key / 4) % 4 + 1).cast("int")
    )
    org = F.concat(F.lit("Общество "), F.col("company"), F.lit(" "), F.col("o_custkey") % 2)
    item = F.when(key % 5 != 0, F.concat(F.lit("Статья "), F.left("o_orderpriority", F.lit(1))))
    amount = comma_text(F.col("o_totalprice"))
    orders = sales(spark, sf).withColumn("source_file", workbook("ОСВ 50-51"))
    return counted(orders, key, [key % 4 == 0, key % 2 == 0, F.lit(True)], 4).select(
        "grp",
        "company",
        "source_file",
        "row_no",
        case(account, org, moment_text(F.col("day"), key)).alias("stacked"),
        case(None, None, item).alias("dim"),
        case(None, None, F.when(F.col("o_orderstatus") != "F", amount)).alias("receipt"),
        case(None, None, F.when(F.col("o_orderstatus") != "O", amount)).alias("payment"),
    )


TRIAL_SQL = f"""
trial_sheet_rows AS (
  SELECT grp, company, {_workbook_sql('ОСВ 50-51')} AS source_file, o_orderkey * 3 + 4 AS row_no,
         CASE (o_orderkey // 4) % 4 WHEN 0 THEN '50.01' WHEN 1 THEN '51' WHEN 2 THEN '50.03' ELSE '50.02' END AS stacked,
         NULL::VARCHAR AS dim, NULL::VARCHAR AS receipt, NULL::VARCHAR AS payment
  FROM sales WHERE o_orderkey % 4 = 0
  UNION ALL
  SELECT grp, company, {_workbook_sql('ОСВ 50-51')}, o_orderkey * 3 + 5,
         'Общество ' || company || ' ' || (o_custkey % 2), NULL, NULL, NULL
  FROM sales WHERE o_orderkey % 2 = 0
  UNION ALL
  SELECT grp, company, {_workbook_sql('ОСВ 50-51')}, o_orderkey * 3 + 6, {_moment_sql('day', 'o_orderkey')},
         CASE WHEN o_orderkey % 5 <> 0 THEN 'Статья ' || left(o_orderpriority, 1) END,
         CASE WHEN o_orderstatus <> 'F' THEN {_comma_sql('o_totalprice')} END,
         CASE WHEN o_orderstatus <> 'O' THEN {_comma_sql('o_totalprice')} END
  FROM sales),
{counted_sql('trial_sheet', 4)}"""


def debt_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Trial balance of accounts 66 and 67: up to five stacked rows per order line."""
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_suppkey").alias("s_suppkey"),
            F.min(F.col("l_shipdate").cast("date")).alias("day"),
            F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"),
            F.min("l_returnflag").alias("flag"),
        )
    )
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    rows = lines.join(supplier, "s_suppkey").join(places(spark, sf), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("source_file", workbook("ОСВ 66-67"))
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    code = F.col("s_suppkey") % 10
    account = F.concat(F.when(code < 5, "66.0").otherwise("67.0"), code % 5 + 1)
    amount = comma_text(F.col("amount"))
    always = F.lit(True)
    return counted(rows, key, [always, always, always, F.col("l_linenumber") % 2 == 0, always], 6).select(
        "grp",
        "company",
        "source_file",
        "row_no",
        case(
            account,
            F.concat(F.lit("ООО "), F.col("company")),
            F.concat(F.lit("770000000"), code),
            F.concat(F.lit("Договор "), F.col("s_suppkey") % 2),
            moment_text(F.col("day"), key),
        ).alias("stacked"),
        case(None, None, F.concat(F.lit("Банк "), code)).alias("creditor"),
        case(None, None, None, None, F.when(F.col("flag") != "R", amount)).alias("receipt"),
        case(None, None, None, None, F.when(F.col("flag") == "R", amount)).alias("payment"),
    )


_CODE = "(s_suppkey % 10)"
DEBT_SQL = f"""
debt_lines AS (
  SELECT l_orderkey * 8 + l_linenumber AS k, l_linenumber, min(l_suppkey) AS s_suppkey,
         min(CAST(l_shipdate AS DATE)) AS day, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount,
         min(l_returnflag) AS flag
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
debt_base AS (
  SELECT l.*, grp, company, {_workbook_sql('ОСВ 66-67')} AS source_file,
         CASE WHEN {_CODE} < 5 THEN '66.0' ELSE '67.0' END || ({_CODE} % 5 + 1) AS account
  FROM debt_lines l JOIN supplier USING (s_suppkey) JOIN places ON s_nationkey = n_nationkey),
debt_sheet_rows AS (
  SELECT grp, company, source_file, k * 5 + 6 AS row_no, account AS stacked, NULL::VARCHAR AS creditor,
         NULL::VARCHAR AS receipt, NULL::VARCHAR AS payment FROM debt_base
  UNION ALL
  SELECT grp, company, source_file, k * 5 + 7, 'ООО ' || company, NULL, NULL, NULL FROM debt_base
  UNION ALL
  SELECT grp, company, source_file, k * 5 + 8, '770000000' || {_CODE}, 'Банк ' || {_CODE}, NULL, NULL FROM debt_base
  UNION ALL
  SELECT grp, company, source_file, k * 5 + 9, 'Договор ' || (s_suppkey % 2), NULL, NULL, NULL
  FROM debt_base WHERE l_linenumber % 2 = 0
  UNION ALL
  SELECT grp, company, source_file, k * 5 + 10, {_moment_sql('day', 'k')}, NULL,
         CASE WHEN flag <> 'R' THEN {_comma_sql('amount')} END,
         CASE WHEN flag = 'R' THEN {_comma_sql('amount')} END
  FROM debt_base),
{counted_sql('debt_sheet', 6)}"""


def _outline(spark: SparkSession, sf: str, name: F.Column, indicator, first: int, cells) -> DataFrame:
    """An outline sheet: ``cells`` lists (level, emitted when, label, measure) per order."""
    levels, when, labels, measures = zip(*cells, strict=True)
    orders = sales(spark, sf).withColumn("indicator", indicator).withColumn("source_file", name)
    return counted(orders, F.col("o_orderkey"), list(when), first).select(
        "grp",
        "company",
        "source_file",
        "indicator",
        "row_no",
        F.element_at(F.array(*[F.lit(level) for level in levels]), F.col("i") + 1).alias("level"),
        case(*labels).alias("c0"),
        case(*measures).alias("c1"),
    )


def cost_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return _cost_outline(spark, sf, workbook(L.COST_OF_SALES), F.lit(L.COST_OF_SALES))


def _cost_outline(spark: SparkSession, sf: str, name: F.Column, indicator: F.Column) -> DataFrame:
    """Outline of the cost reports: organisation, accounts, kind, item and date rows per order."""
    key, always = F.col("o_orderkey"), F.lit(True)
    return _outline(
        spark,
        sf,
        name,
        indicator,
        6,
        [
            (0, key % 3 == 0, F.concat_ws(" ", "company", F.col("o_custkey") % 2), None),
            (1, key % 3 == 0, F.lit("90.02"), None),
            (2, key % 3 == 0, F.lit("41.01"), None),
            (3, key % 2 == 0, F.concat(F.lit("Вид "), F.col("o_custkey") % 2), None),
            (
                4,
                always,
                F.when(key % 7 != 0, F.concat(F.col("o_orderpriority"), F.lit(","), F.left("o_orderpriority", F.lit(1)))),
                None,
            ),
            (5, always, date_text(F.col("day"), key), comma_text(F.col("o_totalprice"))),
        ],
    )


COST_SQL = f"""
cost_sheet_rows AS (
  SELECT grp, company, {_workbook_sql(L.COST_OF_SALES)} AS source_file, '{L.COST_OF_SALES}' AS indicator,
         o_orderkey * 6 + 6 + level AS row_no, level,
         CASE level WHEN 0 THEN company || ' ' || (o_custkey % 2) WHEN 1 THEN '90.02' WHEN 2 THEN '41.01'
              WHEN 3 THEN 'Вид ' || (o_custkey % 2)
              WHEN 4 THEN CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority || ',' || left(o_orderpriority, 1) END
              ELSE {_date_sql('day', 'o_orderkey')} END AS c0,
         CASE WHEN level = 5 THEN {_comma_sql('o_totalprice')} END AS c1
  FROM sales, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS level)
  WHERE level >= 4 OR (level = 3 AND o_orderkey % 2 = 0) OR (level < 3 AND o_orderkey % 3 = 0)),
{counted_sql('cost_sheet', 6)}"""


def indicator_of_costs() -> F.Column:
    return F.element_at(F.array(*[F.lit(c) for c in L.COMPONENTS[1:]]), (F.floor(F.col("o_orderkey") / 6) % 6 + 1).cast("int"))


def costs_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The cost outline, dealt out to the six reports of its shape, a workbook each."""
    name = F.concat(F.lit("("), "grp", F.lit(")"), "indicator", F.lit("_"), "company", F.lit(".xlsx"))
    return _cost_outline(spark, sf, name, indicator_of_costs())


COSTS_SQL = f"""{COST_SQL},
costs_sheet_rows AS (
  SELECT grp, company, '(' || grp || ')' || kind || '_' || company || '.xlsx' AS source_file, kind AS indicator, row_no, level, c0, c1
  FROM (SELECT *, ['Себестоимость продаж', 'Коммерческие расходы', 'Управленческие расходы', 'Прочие доходы', 'Прочие расходы',
                   'Налог на прибыль'][CAST(((row_no - 6) // 6) // 6 % 6 + 1 AS INTEGER)] AS kind FROM cost_sheet_rows)),
{counted_sql('costs_sheet', 6)}"""


def revenue_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Outline of the revenue report, down to the operation."""
    key, always = F.col("o_orderkey"), F.lit(True)
    buyer = F.concat(F.lit("Покупатель "), F.col("o_custkey") % 5)
    item = (
        F.when(F.col("o_custkey") % 5 == 0, F.concat(buyer, F.lit(", ")))
        .when(F.col("o_custkey") % 5 == 1, buyer)
        .otherwise(F.concat(buyer, F.lit(", ООО,77"), F.col("o_custkey") % 5))
    )
    return _outline(
        spark,
        sf,
        workbook(L.REVENUE),
        F.lit(L.REVENUE),
        8,
        [
            (0, always, F.concat_ws(" ", "company", F.col("o_custkey") % 2), None),
            (1, key % 3 == 0, F.lit("90.01"), None),
            (2, key % 3 == 0, F.lit("62.01"), None),
            (3, key % 2 == 0, F.concat(F.lit("Вид "), F.col("o_custkey") % 2), None),
            (4, always, item, None),
            (5, always, date_text(F.col("day"), key), None),
            (6, always, F.concat(F.lit("Документ "), key), None),
            (7, always, F.concat(F.lit("Операция "), key % 3), comma_text(F.col("o_totalprice"))),
        ],
    )


REVENUE_SQL = f"""
revenue_sheet_rows AS (
  SELECT grp, company, {_workbook_sql(L.REVENUE)} AS source_file, '{L.REVENUE}' AS indicator,
         o_orderkey * 8 + 8 + level AS row_no, level,
         CASE level WHEN 0 THEN company || ' ' || (o_custkey % 2) WHEN 1 THEN '90.01' WHEN 2 THEN '62.01'
              WHEN 3 THEN 'Вид ' || (o_custkey % 2)
              WHEN 4 THEN 'Покупатель ' || (o_custkey % 5) ||
                   CASE o_custkey % 5 WHEN 0 THEN ', ' WHEN 1 THEN '' ELSE ', ООО,77' || (o_custkey % 5) END
              WHEN 5 THEN {_date_sql('day', 'o_orderkey')}
              WHEN 6 THEN 'Документ ' || o_orderkey
              ELSE 'Операция ' || (o_orderkey % 3) END AS c0,
         CASE WHEN level = 7 THEN {_comma_sql('o_totalprice')} END AS c1
  FROM sales, (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS level)
  WHERE level IN (0, 4, 5, 6, 7) OR (level = 3 AND o_orderkey % 2 = 0) OR (level < 3 AND o_orderkey % 3 = 0)),
{counted_sql('revenue_sheet', 8)}"""


def deduction_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Outline of the deductions, down to the operation; the operation of every order recurs."""
    key, always = F.col("o_orderkey"), F.lit(True)
    return _outline(
        spark,
        sf,
        workbook(L.DEDUCTIONS),
        F.lit(L.DEDUCTIONS),
        6,
        [
            (0, always, F.concat_ws(" ", "company", F.col("o_custkey") % 2), None),
            (1, key % 3 == 0, F.lit("90.03"), None),
            (2, key % 3 == 0, F.lit("68.02"), None),
            (3, always, date_text(F.col("day"), key), None),
            (4, always, F.concat(F.lit("Документ "), key), None),
            (5, always, F.concat(F.lit("Операция "), key % 3), comma_text(F.floor(F.col("o_totalprice") / 6))),
        ],
    )


DEDUCTION_SQL = f"""
deduction_sheet_rows AS (
  SELECT grp, company, {_workbook_sql(L.DEDUCTIONS)} AS source_file, '{L.DEDUCTIONS}' AS indicator,
         o_orderkey * 6 + 6 + level AS row_no, level,
         CASE level WHEN 0 THEN company || ' ' || (o_custkey % 2) WHEN 1 THEN '90.03' WHEN 2 THEN '68.02'
              WHEN 3 THEN {_date_sql('day', 'o_orderkey')}
              WHEN 4 THEN 'Документ ' || o_orderkey
              ELSE 'Операция ' || (o_orderkey % 3) END AS c0,
         CASE WHEN level = 5 THEN {_comma_sql('floor(o_totalprice / 6)')} END AS c1
  FROM sales, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS level)
  WHERE level IN (0, 3, 4, 5) OR o_orderkey % 3 = 0),
{counted_sql('deduction_sheet', 6)}"""


def bank_statements(spark: SparkSession, sf: str) -> DataFrame:
    """One bank line per order, with every irregularity the parser meets; two workbooks per company share row numbers."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    amount = locale_text(F.col("o_totalprice"))
    return sales(spark, sf).select(
        "grp",
        "company",
        F.when(key % 2 == 0, workbook("Банковские выписки")).otherwise(workbook("Банковские выписки 2")).alias("source_file"),
        F.floor(key / 2).alias("row_no"),
        date_text(F.col("day"), key).alias("date"),
        F.when(F.col("o_orderstatus") != "F", amount).alias("receipt"),
        F.when(F.col("o_orderstatus") != "O", amount).alias("payment"),
        F.when(key % 10 != 0, F.concat(F.lit("Заказ "), key)).alias("purpose"),
        F.when(customer % 50 != 0, F.col("c_name")).alias("counterparty"),
        F.when(customer % 3 != 0, F.concat(customer + 7700000000, F.lit(".0"))).alias("inn"),
        F.when(key % 97 != 0, F.col("o_orderpriority")).alias("op_type"),
        F.col("n_name").alias("org"),
        F.concat(F.lit("40702"), F.col("n_name")).alias("bank_account"),
    )


BANK_SQL = f"""
bank_statements AS (
  SELECT grp, company, CASE WHEN o_orderkey % 2 = 0 THEN {_workbook_sql('Банковские выписки')}
              ELSE {_workbook_sql('Банковские выписки 2')} END AS source_file, o_orderkey // 2 AS row_no,
         {_date_sql('day', 'o_orderkey')} AS date,
         CASE WHEN o_orderstatus <> 'F' THEN {_locale_sql('o_totalprice')} END AS receipt,
         CASE WHEN o_orderstatus <> 'O' THEN {_locale_sql('o_totalprice')} END AS payment,
         CASE WHEN o_orderkey % 10 <> 0 THEN 'Заказ ' || o_orderkey END AS purpose,
         CASE WHEN o_custkey % 50 <> 0 THEN c_name END AS counterparty,
         CASE WHEN o_custkey % 3 <> 0 THEN (o_custkey + 7700000000) || '.0' END AS inn,
         CASE WHEN o_orderkey % 97 <> 0 THEN o_orderpriority END AS op_type,
         n_name AS org, '40702' || n_name AS bank_account
  FROM sales)"""


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Cash-flow items per company and operation type, read off the orders of the company.

    Each operation type has two entries as a receipt and one as a payment; type 5 is missing as a
    payment, and type 1 also stands for the operations without a type.
    """
    digit = F.left("o_orderpriority", F.lit(1))
    number = digit.cast("int")

    def entry(position, op_type, suffix, direction):
        return F.struct(
            (number * 10 + position).alias("row_no"),
            op_type.alias("op_type"),
            F.concat(F.lit("Статья "), digit).alias("cf_item"),
            F.concat(F.lit("Вид "), digit, F.lit(suffix)).alias("movement_kind"),
            F.element_at(
                F.array(*[F.lit(g) for g in L.ITEM_GROUPS], F.lit("Прочее")), number % 4 + 1
            ).alias("item_group"),
            F.lit(direction).alias("direction"),
        )

    kind, nothing = F.col("o_orderpriority"), F.lit(None).cast("string")
    entries = F.array_compact(
        F.array(
            entry(1, kind, "", L.RECEIPT),
            entry(2, kind, " доп.", L.RECEIPT),
            F.when(number != 5, entry(3, kind, "", L.PAYMENT)),
            F.when(number == 1, entry(4, nothing, " прочее", L.PAYMENT)),
        )
    )
    return (
        sales(spark, sf)
        .select("grp", "company", "o_orderpriority")
        .distinct()
        .select("grp", "company", F.inline(entries))
    )


_GROUPS_SQL = "[" + ", ".join(f"'{g}'" for g in [*L.ITEM_GROUPS, "Прочее"]) + "]"
DICTIONARY_SQL = f"""
dictionary AS (
  SELECT grp, company, CAST(left(o_orderpriority, 1) AS INTEGER) * 10 + p AS row_no,
         CASE WHEN p < 4 THEN o_orderpriority END AS op_type, 'Статья ' || left(o_orderpriority, 1) AS cf_item,
         'Вид ' || left(o_orderpriority, 1) || CASE p WHEN 2 THEN ' доп.' WHEN 4 THEN ' прочее' ELSE '' END AS movement_kind,
         {_GROUPS_SQL}[CAST(left(o_orderpriority, 1) AS INTEGER) % 4 + 1] AS item_group,
         CASE WHEN p < 3 THEN '{L.RECEIPT}' ELSE '{L.PAYMENT}' END AS direction
  FROM (SELECT DISTINCT grp, company, o_orderpriority FROM sales), (SELECT unnest([1, 2, 3, 4]) AS p)
  WHERE p < 3 OR (p = 3 AND left(o_orderpriority, 1) <> '5') OR (p = 4 AND left(o_orderpriority, 1) = '1'))"""

VIEWS = {
    "ledger": LEDGER_SQL,
    "moves": MOVES_SQL,
    "components": COMPONENTS_SQL,
    "events_sheet": EVENTS_SQL,
    "trial_sheet": TRIAL_SQL,
    "debt_sheet": DEBT_SQL,
    "cost_sheet": COST_SQL,
    "costs_sheet": COSTS_SQL,
    "revenue_sheet": REVENUE_SQL,
    "deduction_sheet": DEDUCTION_SQL,
    "bank_statements": BANK_SQL,
    "dictionary": DICTIONARY_SQL,
}
