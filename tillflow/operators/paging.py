"""Pages of a sorted report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_ROWS = 30  # fixed value: rows per page


@dataclass(frozen=True)
class Page:
    number: int
    pages: int
    rows: int
    size: int

    @property
    def has_previous(self) -> bool:
        return self.number > 1

    @property
    def has_next(self) -> bool:
        return self.number < self.pages


def locate(rows: int, wanted: object = 1, size: int = PAGE_ROWS) -> Page:
    """The page meant by ``wanted``: what is no whole number means the first page,
    a number out of range the last one. An empty table has one empty page."""
    pages = max(1, -(-rows // size))
    try:
        number = int(wanted) if not isinstance(wanted, float) or wanted.is_integer() else 1
    except (TypeError, ValueError):
        number = 1
    return Page(number if 1 <= number <= pages else pages, pages, rows, size)


def newest_first(df: DataFrame, wanted: object = 1, size: int = PAGE_ROWS) -> DataFrame:
    """One page, sorted by date descending. The later half of the pages is taken
    from the other end, so that the last page costs no more than the first."""
    page = locate(df.count(), wanted, size)
    first = (page.number - 1) * size
    length = min(size, page.rows - first)
    behind = page.rows - first - length
    if first <= behind:
        found = df.orderBy(F.desc("date")).offset(first).limit(length)
    else:
        found = df.orderBy("date").offset(behind).limit(length)
    return found.orderBy(F.desc("date"))


def page_info(df: DataFrame, size: int = PAGE_ROWS) -> DataFrame:
    """One row per page: its number, how many there are, which neighbours it has."""
    pages = F.greatest(F.lit(1), F.ceil(F.col("rows") / size))
    return (
        df.agg(F.count("*").alias("rows"))
        .select("rows", pages.alias("pages"))
        .select(F.explode(F.sequence(F.lit(1).cast("long"), "pages")).alias("page"), "pages", "rows")
        .withColumns({
            "has_previous": F.col("page") > 1,
            "has_next": F.col("page") < F.col("pages"),
        })
    )
