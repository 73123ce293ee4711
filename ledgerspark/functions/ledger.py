"""Column -> Column rules of the ledger domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import labels as L
from .parsing import as_column, label_with_id


def flow_type(receipt: Column | str) -> Column:
    """A line without a receipt is a payment; a line with both sides counts as a receipt."""
    return F.when(as_column(receipt).isNull(), F.lit(L.PAYMENT)).otherwise(F.lit(L.RECEIPT))


def contains_any(c: Column | str, tokens: list[str]) -> Column:
    c = as_column(c)
    hit = F.lit(False)
    for token in tokens:
        hit = hit | F.contains(c, F.lit(token))
    return hit


def debt_type(account: Column | str) -> Column:
    return (
        F.when(contains_any(account, [".01", ".02"]), F.lit(L.LOANS))
        .when(contains_any(account, [".03", ".04"]), F.lit(L.BORROWINGS))
        .otherwise(F.lit(L.DEBT_SECURITIES))
    )


def debt_part(account: Column | str) -> Column:
    return F.when(contains_any(account, [".01", ".03", ".05"]), F.lit(L.PRINCIPAL)).otherwise(F.lit(L.INTEREST))


def debt_term(account: Column | str) -> Column:
    return F.when(contains_any(account, ["67."]), F.lit(L.LONG_TERM)).otherwise(F.lit(L.SHORT_TERM))


def classify_debt(account: Column | str) -> dict[str, Column]:
    """Debt type, part (principal or interest) and term, all read off the account code."""
    return {
        "debt_type": debt_type(account),
        "debt_part": debt_part(account),
        "debt_term": debt_term(account),
    }


def account_filter(
    account: Column | str, prefix: str | None = None, equals: str | None = None, exclude: tuple[str, ...] = ()
) -> Column:
    account = as_column(account)
    keep = F.lit(True)
    if prefix is not None:
        keep = keep & F.startswith(account, F.lit(prefix))
    if equals is not None:
        keep = keep & (account == equals)
    if exclude:
        keep = keep & ~account.isin(*exclude)
    return keep


def cash_bank_rules(text: Column | str) -> dict[str, Column]:
    """Classes of the undated rows in a trial balance of accounts 50 and 51.

    Text that begins with a digit is an account, any other text an organisation.
    """
    text = as_column(text)
    numeric = F.rlike(text, F.lit(r"^\p{Nd}"))
    return {"account": F.when(numeric, text), "org": F.when(~numeric, text)}


def debt_rules(text: Column | str, creditor: Column | str) -> dict[str, Column]:
    """Classes of the undated rows in a trial balance of accounts 66 and 67.

    A tax-id row completes the creditor's label. Any text that is neither an account nor a tax id
    is a contract, organisation rows included, until the next contract row replaces it.
    """
    text, creditor = as_column(text), as_column(creditor)
    is_account = F.rlike(text, F.lit(r"^[0-9]{2}\.[0-9]{2}$"))
    is_tax_id = F.rlike(text, F.lit(r"^\p{Nd}{10}$|^\p{Nd}{12}$"))
    return {
        "account": F.when(is_account, text),
        "org": F.when(contains_any(text, L.LEGAL_FORMS), text),
        "creditor": label_with_id(creditor, F.when(is_tax_id, text)),
        "contract": F.when(~is_account & ~is_tax_id, text),
    }
