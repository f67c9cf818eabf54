"""Search over detected transactions: optional filters, sort allow-list, paging."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.functions.features import all_of, any_of
from txguard.functions.protect import mask_account
from txguard.functions.rules import method_is
from txguard.schema import DISPLAY_NAMES

SORT_COLUMNS = {"ingested_at", "amount", "step"}
PAGE_SIZE = 50


@dataclass(frozen=True)
class Search:
    """Optional filters; what is left empty does not filter."""

    types: list[str] = field(default_factory=list)
    methods: list[str] = field(default_factory=list)
    account: str = ""

    def predicate(self) -> Column | None:
        parts = []
        if self.types:
            parts.append(F.col("type").isin(self.types))
        if self.methods:
            parts.append(any_of([method_is(m) for m in self.methods]))
        if self.account:
            pattern = "%" + self.account.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_") + "%"
            parts.append(F.col("nameOrig").ilike(pattern) | F.col("nameDest").ilike(pattern))
        return all_of(parts) if parts else None


def search(df: DataFrame, query: Search) -> DataFrame:
    predicate = query.predicate()
    return df if predicate is None else df.where(predicate)


def _order(sort_by: str, descending: bool, tie_break: str) -> list[Column]:
    if sort_by not in SORT_COLUMNS:
        raise ValueError(f"cannot sort by {sort_by!r}; allowed: {sorted(SORT_COLUMNS)}")
    column = F.col(sort_by)
    return [column.desc_nulls_last() if descending else column.asc_nulls_last(), F.col(tie_break).asc()]


def page(df: DataFrame, number: int, *, sort_by: str = "ingested_at", descending: bool = True,
         tie_break: str = "tx_id", size: int = PAGE_SIZE) -> DataFrame:
    """Page ``number`` (from 1) of the sorted rows. Cost grows with the page number; see ``page_after``."""
    return df.orderBy(*_order(sort_by, descending, tie_break)).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, last_value, last_tie, *, sort_by: str = "ingested_at", descending: bool = True,
               tie_break: str = "tx_id", size: int = PAGE_SIZE) -> DataFrame:
    """The page behind a known last row: a pushed-down filter instead of skipped rows, at any depth.

    Missing sort values come last; ``last_value`` is None behind a row that has none.
    """
    column, behind = F.col(sort_by), F.col(tie_break) > last_tie
    if last_value is None:
        rest = df.where(column.isNull() & behind)
    else:
        value = F.lit(last_value)
        beyond = column < value if descending else column > value
        rest = df.where(beyond | ((column == value) & behind) | column.isNull())
    return rest.orderBy(*_order(sort_by, descending, tie_break)).limit(size)


def for_display(df: DataFrame) -> DataFrame:
    """Mask both accounts and use the display names."""
    masked = df.withColumns({c: mask_account(F.col(c)) for c in ("nameOrig", "nameDest") if c in df.columns})
    return masked.withColumnsRenamed({k: v for k, v in DISPLAY_NAMES.items() if k in df.columns})
