"""Queries E5-E10: summaries and timing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.catalog.common import query, table
from tablewright.operators.columns import SelectColumns
from tablewright.operators.profile import SummarizeData
from tablewright.operators.timing import Timer

LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
NUMBERS = LINEITEM[:8]
NAN = "any_value(CAST('NaN' AS DOUBLE))"


def _per_column(columns: list[str], cells, source: str = "lineitem") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"Feature\", {cells(c)} FROM {source}" for c in columns)


def _counts(c):
    return (f'CAST(count({c}) AS DOUBLE) AS "Count", '
            f'CAST(count(*) - count({c}) AS DOUBLE) AS "Missing Value Count"')


def _quantiles(names, probabilities):
    def cells(c):
        if c not in NUMBERS:
            return ", ".join(f'{NAN} AS "{n}"' for n in names)
        return ", ".join(f'CAST(quantile_disc({c}, {p}) AS DOUBLE) AS "{n}"'
                         for n, p in zip(names, probabilities))
    return cells


_basic = _quantiles(["Min", "1st Quartile", "Median", "3rd Quartile", "Max"], [0, 0.25, 0.5, 0.75, 1])
_tails = _quantiles(["P0.5", "P1", "P5", "P95", "P99", "P99.5"],
                    [0.005, 0.01, 0.05, 0.95, 0.99, 0.995])


def _moments(c):
    """Population skewness and excess kurtosis from centered sums."""
    if c not in NUMBERS:
        return ", ".join(f'{NAN} AS "{n}"' for n in (
            "Sample Variance", "Sample Standard Deviation", "Sample Skewness", "Sample Kurtosis"))
    d = f"({c} - (SELECT avg({c}) FROM lineitem))"
    return (f'round(var_samp({c}), 4) AS "Sample Variance", '
            f'round(stddev_samp({c}), 6) AS "Sample Standard Deviation", '
            f'round(avg({d} ** 3) / (avg({d} ** 2) ** 1.5), 6) AS "Sample Skewness", '
            f'round(avg({d} ** 4) / (avg({d} ** 2) ** 2) - 3, 6) AS "Sample Kurtosis"')


def _rounded(df):
    for name, digits in (("Sample Variance", 4), ("Sample Standard Deviation", 6),
                         ("Sample Skewness", 6), ("Sample Kurtosis", 6)):
        df = df.withColumn(name, F.round(name, digits))
    return df


def _summary(spark, sf, **groups):
    switches = {g: groups.get(g, False) for g in ("counts", "basic", "sample", "percentiles")}
    return SummarizeData(**switches).transform(table(spark, sf, "lineitem"))


@query("e5_summary_counts", _per_column(LINEITEM, _counts))
def e5_summary_counts(spark, sf):
    return _summary(spark, sf, counts=True).drop("Unique Value Count")


@query("e5_summary_distinct", _per_column(
    ["o_orderstatus", "o_orderpriority"],
    lambda c: _counts(c) + f', CAST(count(DISTINCT {c}) AS DOUBLE) AS "Unique Value Count"', "orders"))
def e5_summary_distinct(spark, sf):
    return SummarizeData(counts=True, basic=False, sample=False, percentiles=False).transform(
        table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority"))


@query("e6_summary_basic", _per_column(LINEITEM, _basic))
def e6_summary_basic(spark, sf):
    return _summary(spark, sf, basic=True)


@query("e7_summary_sample", _per_column(LINEITEM, _moments))
def e7_summary_sample(spark, sf):
    return _rounded(_summary(spark, sf, sample=True))


@query("e8_summary_percentiles", _per_column(LINEITEM, _tails))
def e8_summary_percentiles(spark, sf):
    return _summary(spark, sf, percentiles=True)


@query("e9_summary_all", _per_column(
    LINEITEM, lambda c: ", ".join([_counts(c), _basic(c), _moments(c), _tails(c)])))
def e9_summary_all(spark, sf):
    out = _summary(spark, sf, counts=True, basic=True, sample=True, percentiles=True)
    return _rounded(out.drop("Unique Value Count"))


@query("e9_summary_approximate")
def e9_summary_approximate(spark, sf):
    """The one-job form: quantiles from the sketch inside the same aggregate."""
    return SummarizeData(errorThreshold=0.001).transform(table(spark, sf, "lineitem"))


@query("e10_timer", "SELECT o_orderkey, o_totalprice FROM orders")
def e10_timer(spark, sf):
    timer = Timer(stage=SelectColumns(cols=["o_orderkey", "o_totalprice"]),
                  disableMaterialization=False)
    return timer.transform(table(spark, sf, "orders"))
