"""Queries over the view of events: filter, search, sort, page, statistics."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsquarry.functions.text import fold


@dataclass(frozen=True)
class EventQuery:
    """A parameterised query; '' means no condition.  ``level`` 'none' means without a level, ``tickers`` is a set to be in."""

    ticker: str = ""
    pillar: str = ""
    severity: str = ""
    level: str = ""
    search: str = ""
    tickers: tuple[str, ...] = ()
    sort: str = "date_desc"
    page: int = 1
    size: int = 50

    def where(self, events: DataFrame) -> DataFrame:
        """All conditions together; the search ignores case and accents and looks into both headlines."""
        out = events
        for column, value in (("ticker", self.ticker), ("esg_type", self.pillar), ("severity", self.severity)):
            if value:
                out = out.where(F.col(column) == value)
        if self.level == "none":
            out = out.where(F.coalesce("controversy_level", F.lit("")) == "")
        elif self.level:
            out = out.where(F.col("controversy_level") == self.level)
        if self.tickers:
            out = out.where(F.col("ticker").isin(*self.tickers))
        if self.search.strip():
            wanted = fold(F.lit(self.search.strip()))
            out = out.where(fold(F.coalesce("headline", F.lit(""))).contains(wanted) | fold(F.coalesce("headline_en", F.lit(""))).contains(wanted))
        return out

    def order(self) -> list[Column]:
        """Sort columns with ties in a defined order: later created first, missing last, then the ticker and the id."""
        created = F.nullif(F.col("created_at"), F.lit("")).desc_nulls_last()
        if self.sort == "ticker_asc":
            return [F.col("ticker").asc(), F.col("date").desc(), created, F.col("id").asc()]
        date = F.col("date").asc() if self.sort == "date_asc" else F.col("date").desc()
        return [date, created, F.col("ticker").asc(), F.col("id").asc()]

    def rows(self, events: DataFrame) -> DataFrame:
        """The page asked for; a page below 1 is the first, one beyond the last is the last."""
        hits = self.where(events)
        pages = max(1, -(-hits.count() // self.size))
        page = min(max(1, self.page), pages)
        return hits.orderBy(*self.order()).offset((page - 1) * self.size).limit(self.size)

    def top(self, events: DataFrame) -> DataFrame:
        """The first page, without counting."""
        return self.where(events).orderBy(*self.order()).limit(self.size)

    def pages(self, events: DataFrame) -> DataFrame:
        return self.where(events).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / self.size)).cast("long").alias("pages"))

    def stats(self, events: DataFrame) -> DataFrame:
        """Counts over all hits, whatever the page."""
        return self.where(events).agg(
            F.count(F.lit(1)).alias("total"), F.count_if(F.col("esg_type") == "E").alias("e"), F.count_if(F.col("esg_type") == "S").alias("s"), F.count_if(F.col("esg_type") == "G").alias("g"),
            F.count_if(F.col("severity") == "high").alias("high"), F.count_if(F.col("controversy_level") == "Major").alias("major"), F.countDistinct("ticker").alias("tickers"),
        )

    def with_(self, **changes) -> EventQuery:
        return replace(self, **changes)


def headline(column: str, english: str, lang: str) -> Column:
    """(text, fallback): the English headline if asked for and not blank, else the other one, marked as a fallback."""
    other = F.coalesce(F.col(column), F.lit(""))
    if lang != "en":
        return F.struct(other.alias("text"), F.lit(False).alias("fallback"))
    blank = F.trim(F.coalesce(F.col(english), F.lit(""))) == ""
    return F.struct(F.when(blank, other).otherwise(F.col(english)).alias("text"), blank.alias("fallback"))


def label(column: str, names: dict[str, str], default: str = "—") -> Column:
    """The label of a value, ``default`` for none."""
    out = F.lit(None).cast("string")
    for k, v in names.items():
        out = F.when(F.col(column) == k, v).otherwise(out)
    return F.coalesce(out, F.lit(default))
