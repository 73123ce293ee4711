"""Labels that appear as values in the source reports and in the published tables."""

# Direction of a money movement.
RECEIPT = "Поступление"
PAYMENT = "Списание"

# Where a cash-flow or balance row comes from.
BANK = "Банк"
CASH = "Касса"

# Fallbacks for missing text.
MISSING_TEXT = "-"
UNMAPPED_GROUP = "Неденежные операции"

# First-seen counterparty flag.
YES = "Да"
NO = "Нет"

# Item groups of the cash-flow dictionary -> published names.
ITEM_GROUPS = {
    "Текущие операции": "Денежные потоки от текущих операций",
    "Инвестиционные операции": "Денежные потоки от инвестиционных операций",
    "Финансовые операции": "Денежные потоки от финансовых операций",
}

# Profit-and-loss indicators.
REVENUE = "Выручка"
COST_OF_SALES = "Себестоимость продаж"
COMMERCIAL_COSTS = "Коммерческие расходы"
ADMINISTRATIVE_COSTS = "Управленческие расходы"
OTHER_INCOME = "Прочие доходы"
OTHER_COSTS = "Прочие расходы"
INCOME_TAX = "Налог на прибыль"
DEDUCTIONS = "НДС-акцизы-экспортные пошлины"

COMPONENTS = [
    REVENUE,
    COST_OF_SALES,
    COMMERCIAL_COSTS,
    ADMINISTRATIVE_COSTS,
    OTHER_INCOME,
    OTHER_COSTS,
    INCOME_TAX,
]

# Profit lines of the statement.
GROSS_PROFIT = "Валовая прибыль (убыток)"
SALES_PROFIT = "Прибыль (убыток) от продаж"
PRE_TAX_PROFIT = "Прибыль (убыток) до налогообложения"
NET_PROFIT = "Чистая прибыль (убыток)"

# Debt classification.
LOANS = "Кредиты"
BORROWINGS = "Займы"
DEBT_SECURITIES = "Долговые ценные бумаги"
PRINCIPAL = "Основной долг"
INTEREST = "Проценты"
LONG_TERM = "Долгосрочная задолженность"
SHORT_TERM = "Краткосрочная задолженность"

# Legal forms that mark an organisation row ("ПТ " ends with a space).
LEGAL_FORMS = [
    "ИП", "ООО", "ОДО", "АО", "ЗАО", "ПАО", "НПАО",
    "ХТ", "ХО", "ПК", "ПТ ", "КТ", "СПК", "ТОО",
    "Колхоз", "Коопхоз", "ФГП", "ФГУП", "ОГУП",
    "КГУП", "РГУП", "МУП",
]

# Report names inside workbook file names.
BANK_STATEMENTS = "Банковские выписки"
CASH_FLOW_DICTIONARY = "Статьи движения денежных средств"
TRIAL_BALANCE = "ОСВ 50-51"
DEBT_BALANCE = "ОСВ 66-67"
