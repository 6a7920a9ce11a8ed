"""Pages of an ordered listing (ids O2, O3, A9)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Page:
    """One page of a listing; ``total`` runs its own count."""

    matches: DataFrame
    data: DataFrame
    page: int
    page_size: int

    @property
    def total(self) -> int:
        return self.matches.count()


def take_page(df: DataFrame, order_by: Sequence[str], page: int = 1, page_size: int = 20) -> DataFrame:
    """O2: rows (page-1)*size .. page*size of the given total order.

    Spark keeps the first skip + size rows of every task, so the memory grows with the page number, not the data.
    """
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    skip = (page - 1) * page_size
    return df.orderBy(*order_by).offset(skip).limit(page_size)


def preview(df: DataFrame, rows: int = 3) -> DataFrame:
    """The first rows."""
    return df.limit(rows)
