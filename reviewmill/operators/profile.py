"""Profiles of the review table: nulls, counts, distributions, correlations, rates by group and year."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import values
from reviewmill.operators import ordering
from reviewmill.operators.lookup import lookup
from reviewmill.session import materialise


def as_rows(pairs: Sequence[tuple[str, Column]], key: str, value: str) -> Column:
    """An expression that turns one row into one ``(key, value)`` row per pair."""
    return F.inline(F.array(*[F.struct(F.lit(k).alias(key), v.alias(value)) for k, v in pairs]))


def table_profile(table: DataFrame) -> DataFrame:
    """``(place, column, type, n_rows, n_columns)``, one row per column."""
    columns = [
        F.struct(F.lit(i).alias("place"), F.lit(name).alias("column"), F.lit(kind).alias("type"))
        for i, (name, kind) in enumerate(table.dtypes)
    ]
    rows = table.agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select(
        F.inline(F.array(*columns)), "n_rows", F.lit(len(columns)).cast("bigint").alias("n_columns")
    )


def null_profile(table: DataFrame) -> DataFrame:
    """``(column, nulls, total)``, all columns in one pass."""
    counts = table.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in table.columns],
    )
    pairs = [(c, F.col(c)) for c in table.columns]
    return counts.select(F.col("_total").alias("total"), as_rows(pairs, "column", "nulls")).select(
        "column", "nulls", "total"
    )


def since_year(reviews: DataFrame, year: int, date: str = "review_date") -> DataFrame:
    """Rows dated in ``year`` or later; rows without a valid date go too."""
    return reviews.where(F.year(values.lenient_date(F.col(date))) >= year)


def since_year_report(reviews: DataFrame, year: int, date: str = "review_date") -> DataFrame:
    parsed = F.year(values.lenient_date(F.col(date)))
    kept = F.count_if(parsed >= year)
    total = F.count(F.lit(1))
    return reviews.agg(
        total.alias("total"),
        kept.alias("kept"),
        (total - kept).alias("dropped"),
        F.count_if(parsed.isNull()).alias("without_date"),
    )


def value_counts(table: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return (
        table.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )


def cross_counts(table: DataFrame, first: str, second: str) -> DataFrame:
    return (
        table.where(F.col(first).isNotNull() & F.col(second).isNotNull())
        .groupBy(first, second)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def long_numbers(table: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(column, value)`` rows, one per number, next to the kept columns."""
    pairs = [(c, F.col(c).cast("double")) for c in columns]
    return table.select(*keep, as_rows(pairs, "column", "value"))


def medians(table: DataFrame, columns: Sequence[str]) -> Column:
    """Exact medians as one struct, a scalar subquery with a field per column."""
    found = ordering.exact_quantiles(
        long_numbers(table, columns), "value", {"median": 0.5}, ["column"]
    )
    fields = [F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in columns]
    return found.agg(F.struct(*fields).alias("medians")).scalar()


def with_medians_filled(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of numeric columns replaced by the column's exact median, as doubles."""
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    missing = [c for c in columns if counted[c]]
    plain = {c: F.col(c).cast("double") for c in columns}
    if not missing:
        return table.withColumns(plain)
    found = table.withColumn("_medians", medians(table, missing))
    filled = {c: F.coalesce(plain[c], F.col("_medians").getField(c)) for c in missing}
    return found.withColumns(plain | filled).drop("_medians")


def ordinal_codes(table: DataFrame, column: str) -> DataFrame:
    """``(category, code, n)``: distinct values, null as 'unknown', in alphabetical order from 0."""
    counts = table.groupBy(F.coalesce(column, F.lit("unknown")).alias("category")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return ordering.with_ordinal(counts, ["category"], "code")


def with_ordinal_code(table: DataFrame, column: str, name: str, spread_by: str = "doc_id") -> DataFrame:
    codes = ordinal_codes(table, column).select("category", F.col("code").alias(name))
    keyed = table.withColumn("category", F.coalesce(column, F.lit("unknown")))
    return lookup(keyed, codes, "category", spread_by).drop("category")


def correlations(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, r)``: Pearson coefficients of all pairs in one pass; null for a constant column."""
    filled = with_medians_filled(table.select(*columns), columns)
    deviations = [F.stddev_pop(c).alias(f"_dev_{i}") for i, c in enumerate(columns)]
    numbered = list(enumerate(columns))
    covariances = [
        F.covar_pop(a, b).alias(f"_cov_{i}_{j}") for (i, a), (j, b) in combinations(numbered, 2)
    ]
    moments = filled.agg(*deviations, *covariances)
    entries = []
    for i, a in numbered:
        for j, b in numbered:
            product = F.col(f"_dev_{i}") * F.col(f"_dev_{j}")
            top = product if i == j else F.col(f"_cov_{min(i, j)}_{max(i, j)}")
            entries.append(
                F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.try_divide(top, product).alias("r"))
            )
    return moments.select(F.inline(F.array(*entries)))


def correlations_with(matrix: DataFrame, target: str) -> DataFrame:
    """The other columns by their correlation with the target, strongest positive first."""
    return (
        matrix.where((F.col("a") != target) & (F.col("b") == target))
        .select(F.col("a").alias("feature"), "r")
        .orderBy(F.desc_nulls_last("r"), "feature")
    )


def class_distributions(table: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Box statistics per column and class: extremes, quartiles, and the whisker ends.

    Whiskers reach the outermost values within 1.5 interquartile ranges of the box.
    """
    group = ["column", "class"]
    rows = long_numbers(
        table.where(F.col(label).isNotNull()).withColumn("class", F.col(label).cast("string")),
        columns,
        ["class"],
    )
    counted = ordering.counted_values(rows, "value", group)
    boxes = ordering.quantiles_of_counted(
        counted, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, group
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    return (
        counted.join(materialise(boxes, "boxes"), group)
        .groupBy(*group, "q1", "median", "q3")
        .agg(
            F.sum("n").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        )
    )


def class_histograms(
    table: DataFrame, columns: Sequence[str], label: str, bins: int = 20
) -> DataFrame:
    """``(column, class, bin, n)``: fixed-width bins over each column's whole range."""
    bounds = table.agg(
        F.struct(
            *[
                F.struct(
                    F.min(F.col(c).cast("double")).alias("low"),
                    F.max(F.col(c).cast("double")).alias("high"),
                ).alias(c)
                for c in columns
            ]
        ).alias("bounds")
    )
    labelled = table.where(F.col(label).isNotNull()).withColumn("_bounds", bounds.scalar())

    def bin_of(c: str) -> Column:
        low, high = F.col("_bounds").getField(c)["low"], F.col("_bounds").getField(c)["high"]
        place = F.floor(F.try_divide((F.col(c).cast("double") - low) * bins, high - low))
        # A column of one value has a single bin; its highest value belongs to the last bin.
        placed = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("bigint")
        return F.when(F.col(c).isNotNull(), placed)

    return (
        labelled.select(
            F.col(label).cast("string").alias("class"),
            as_rows([(c, bin_of(c)) for c in columns], "column", "bin"),
        )
        .where("bin IS NOT NULL")
        .groupBy("column", "class", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_group_rates(table: DataFrame, group: str, flag: str, k: int = 15) -> DataFrame:
    """The ``k`` largest groups by their rate of true flags, beside the rate over all rows."""
    rate = F.avg(F.col(flag).cast("int"))
    groups = (
        table.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), rate.alias("rate"))
        .orderBy(F.desc("n"), group)
        .limit(k)
    )
    overall = table.agg(rate).scalar()
    return groups.withColumn("overall_rate", overall).orderBy(F.desc_nulls_last("rate"), group)


def yearly_counts(reviews: DataFrame, label: str = "is_a_buyer", date: str = "review_date") -> DataFrame:
    """Reviews per year and class; a class without reviews counts 0. A malformed date is an error."""
    dated = reviews.where(F.col(label).isNotNull()).select(
        F.year(values.strict_date(F.col(date))).alias("year"),
        F.col(label).cast("string").alias("class"),
    )
    counts = dated.groupBy("year").pivot("class", ["true", "false"]).count().na.fill(0)
    return counts.select(
        "year", F.col("true").alias("n_true"), F.col("false").alias("n_false")
    )


def yearly_rates(reviews: DataFrame, label: str = "is_a_buyer", date: str = "review_date") -> DataFrame:
    return (
        reviews.groupBy(F.year(values.strict_date(F.col(date))).alias("year"))
        .agg(F.avg(F.col(label).cast("int")).alias("rate"))
        .withColumn("other_rate", 1 - F.col("rate"))
    )


def class_balance(table: DataFrame, label: str) -> DataFrame:
    """Mean and complement of a 0/1 label."""
    return table.agg(
        F.count(label).alias("n"),
        F.avg(label).alias("positive"),
        (1 - F.avg(label)).alias("negative"),
    )


def token_count_stats(documents: DataFrame) -> DataFrame:
    """Exact median of the token counts, and how many documents have no token."""
    sizes = documents.select(F.lit("tokens").alias("column"), F.size("tokens").alias("value"))
    counted = ordering.counted_values(sizes, "value", ["column"])
    median = ordering.quantiles_of_counted(counted, "value", {"median": 0.5}, ["column"])
    empty = F.coalesce(F.sum(F.when(F.col("value") == 0, F.col("n"))), F.lit(0))
    return counted.agg(F.sum("n").alias("n"), empty.alias("empty")).withColumn(
        "median_tokens", median.select("median").scalar()
    )


def class_densities(
    table: DataFrame, columns: Sequence[str], label: str, points: int = 50, bins: int = 400
) -> DataFrame:
    """``(column, class, point, x, density)``: a Gaussian kernel density at evenly spaced points of each group's range.

    The bandwidth is Scott's: the group's sample deviation times n to the power of -1/5. Values are counted in
    ``bins`` of equal width first, and each bin meets each point, so the work beyond the counts does not
    grow with the rows. A group whose values are all equal has no bandwidth and no density.
    """
    group = ["column", "class"]
    rows = materialise(
        long_numbers(
            table.where(F.col(label).isNotNull()).withColumn("class", F.col(label).cast("string")), columns, ["class"]
        ).where("value IS NOT NULL"),
        "numbers",
    )
    spread = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("size"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.stddev_samp("value").alias("deviation"),
    ).where("high > low")
    spread = materialise(
        spread.withColumn("width", F.col("deviation") * F.pow(F.col("size").cast("double"), F.lit(-0.2))), "spread"
    )
    place = F.floor((F.col("value") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    counted = (
        rows.join(spread, group)
        .groupBy(*group, "low", "high", "size", "width", F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    reach = F.col("high") - F.col("low")
    middle = F.col("low") + (F.col("bin") + 0.5) * reach / bins
    x = F.col("low") + F.col("point") * reach / (points - 1)
    off = (x - middle) / F.col("width")
    scale = F.col("size") * F.col("width") * F.sqrt(F.lit(2.0) * F.pi())
    return (
        counted.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy(*group, "point", x.alias("x"))
        .agg(F.sum(F.col("n") * F.exp(-0.5 * off * off) / scale).alias("density"))
    )
