from .ledger import (
    account_filter,
    cash_bank_rules,
    classify_debt,
    contains_any,
    debt_part,
    debt_rules,
    debt_term,
    debt_type,
    flow_type,
)
from .parsing import (
    DATE_FORMATS,
    DATETIME_FORMATS,
    MONEY,
    clean_tax_id,
    file_company,
    file_group,
    label_with_id,
    parse_locale_number,
    parse_multi_date,
    parse_multi_datetime,
    split_last_comma,
)

__all__ = [
    "DATE_FORMATS",
    "DATETIME_FORMATS",
    "MONEY",
    "account_filter",
    "cash_bank_rules",
    "classify_debt",
    "clean_tax_id",
    "contains_any",
    "debt_part",
    "debt_rules",
    "debt_term",
    "debt_type",
    "file_company",
    "file_group",
    "flow_type",
    "label_with_id",
    "parse_locale_number",
    "parse_multi_date",
    "parse_multi_datetime",
    "split_last_comma",
]
