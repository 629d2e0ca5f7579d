"""Which of several date formats a text column is written in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.values import lenient_date


def format_votes(table: DataFrame, column: str, formats: Sequence[str]) -> DataFrame:
    """``(place, format, parsed, alone, ambiguous, elected)``, a row per format, from one pass.

    ``parsed`` rows read as a date in the format, ``alone`` in no other one; ``ambiguous`` ones read as another
    date in another format. The format with most parsed rows is elected, of equal ones the one with most
    rows of its own, then the first given; if nothing parses, none. Null texts parse in no format.
    """
    dates = [lenient_date(F.col(column), f) for f in formats]
    read = F.array(*dates)
    known = F.array_compact(read)

    def sums(i: int) -> Column:
        mine = F.get("_read", F.lit(i))
        others = F.exists("_known", lambda d: d != mine)
        return F.struct(
            F.lit(i).alias("place"),
            F.lit(formats[i]).alias("format"),
            F.count_if(mine.isNotNull()).alias("parsed"),
            F.count_if(mine.isNotNull() & (F.size("_known") == 1)).alias("alone"),
            F.count_if(mine.isNotNull() & others).alias("ambiguous"),
        )

    votes = (
        table.select(read.alias("_read"), known.alias("_known"))
        .agg(F.array(*map(sums, range(len(formats)))).alias("votes"))
        .withColumn("best", F.array_max(F.transform("votes", lambda v: F.struct(v["parsed"], v["alone"], -v["place"]))))
    )
    return votes.select(F.col("best.parsed").alias("_most"), (-F.col("best.col3")).alias("_winner"), F.inline("votes")).select(
        "place", "format", "parsed", "alone", "ambiguous",
        ((F.col("place") == F.col("_winner")) & (F.col("_most") > 0)).alias("elected"),
    )


def elected_format(table: DataFrame, column: str, formats: Sequence[str]) -> str | None:
    """The elected format, to read the column with; None if no row parses in any."""
    winner = format_votes(table, column, formats).where("elected").first()
    return winner and winner["format"]
