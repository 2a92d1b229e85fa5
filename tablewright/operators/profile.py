"""One-row-per-column summary of a table."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import StageBase, as_bool, as_float, param
from tablewright.functions.missing import is_missing, is_numeric, no_nan
from tablewright.plans.quantiles import COLUMNS_PER_PASS, exact_quantiles

# fixed values: names of the output columns and the probabilities behind them
FEATURE = "Feature"
COUNT_FIELDS = ["Count", "Unique Value Count", "Missing Value Count"]
BASIC_FIELDS = ["Min", "1st Quartile", "Median", "3rd Quartile", "Max"]
BASIC_PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 1.0]
SAMPLE_FIELDS = ["Sample Variance", "Sample Standard Deviation", "Sample Skewness",
                 "Sample Kurtosis"]
PERCENTILE_FIELDS = ["P0.5", "P1", "P5", "P95", "P99", "P99.5"]
PERCENTILE_PROBABILITIES = [0.005, 0.01, 0.05, 0.95, 0.99, 0.995]


# buffer fields of the three moment aggregates of a column, and how many an aggregate may hold
MOMENT_FIELDS, CODEGEN_FIELDS = 12, 96


class SummarizeData(StageBase, Transformer):
    """Counts, quantiles, moments and tail percentiles of every column.

    Counts and moments come from generated-code aggregates, distinct counts and sketches from
    another; each result row is turned into one row per column. ``errorThreshold`` 0 gives
    exact rank quantiles, above 0 they come from the sketch.
    """

    counts = param("counts", "compute count statistics", as_bool)
    basic = param("basic", "compute basic statistics", as_bool)
    sample = param("sample", "compute sample statistics", as_bool)
    percentiles = param("percentiles", "compute percentiles", as_bool)
    errorThreshold = param("errorThreshold", "threshold for quantiles - 0 is exact", as_float)

    _defaults = {"counts": True, "basic": True, "sample": True, "percentiles": True,
                 "errorThreshold": 0.0}

    def output_fields(self) -> list[str]:
        fields = []
        if self.getCounts():
            fields += COUNT_FIELDS
        if self.getBasic():
            fields += BASIC_FIELDS
        if self.getSample():
            fields += SAMPLE_FIELDS
        if self.getPercentiles():
            fields += PERCENTILE_FIELDS
        return fields

    def output_schema(self) -> T.StructType:
        return T.StructType([T.StructField(FEATURE, T.StringType(), False)] + [
            T.StructField(f, T.DoubleType(), f not in COUNT_FIELDS)
            for f in self.output_fields()])

    def _transform(self, df: DataFrame) -> DataFrame:
        probabilities = ((BASIC_PROBABILITIES if self.getBasic() else [])
                         + (PERCENTILE_PROBABILITIES if self.getPercentiles() else []))
        exact = {}
        if probabilities and self.getErrorThreshold() == 0:
            numeric = [f.name for f in df.schema if is_numeric(f.dataType)]
            if numeric:
                exact = exact_quantiles(df, numeric, probabilities)
        wide = self._sketches(df, probabilities if not exact else [])
        plain = self._counts_and_moments(df)
        # one row per column of the input on either side
        both = plain.join(F.broadcast(wide), FEATURE) if wide is not None else plain
        return self._assemble(df, both, probabilities, exact)

    def _counts_and_moments(self, df: DataFrame) -> DataFrame:
        """(Feature, total, present, variance, skewness, kurtosis). An aggregate leaves
        whole-stage code generation when its buffers hold too many fields, so the columns are
        dealt out to aggregates that stay below that; each column is read by one of them."""
        parts, batch, used = [], [], 1
        for field in df.schema:
            cost = 1 + (MOMENT_FIELDS if self.getSample() and is_numeric(field.dataType) else 0)
            if batch and used + cost > CODEGEN_FIELDS:
                parts.append(self._one_aggregate(df, batch))
                batch, used = [], 1
            batch.append(field)
            used += cost
        parts.append(self._one_aggregate(df, batch))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _one_aggregate(self, df: DataFrame, fields: list[T.StructField]) -> DataFrame:
        aggregates, rows = [F.count(F.lit(1)).alias("total")], []
        none = F.lit(None).cast("double")
        for i, field in enumerate(fields):
            column = F.col(f"`{field.name}`")
            aggregates.append(F.count(F.when(~is_missing(column, field.dataType), 1)).alias(f"n{i}"))
            moments = [none] * 3
            if self.getSample() and is_numeric(field.dataType):
                value = column.cast("double")
                aggregates += [F.var_samp(value).alias(f"v{i}"), F.skewness(value).alias(f"w{i}"),
                               F.kurtosis(value).alias(f"k{i}")]
                moments = [F.col(f"{k}{i}") for k in "vwk"]
            rows.append(F.struct(
                F.lit(field.name).alias(FEATURE), F.col("total"), F.col(f"n{i}").alias("present"),
                *[m.alias(n) for m, n in zip(moments, ("variance", "skewness", "kurtosis"))]))
        return df.agg(*aggregates).select(F.inline(F.array(*rows)))

    def _sketches(self, df: DataFrame, probabilities: list[float]) -> DataFrame | None:
        """(Feature, distinct, quantiles) from the aggregates that hold sketches."""
        if not self.getCounts() and not probabilities:
            return None
        out = None
        for start in range(0, len(df.columns), COLUMNS_PER_PASS):
            aggregates, rows = [], []
            for i, field in enumerate(df.schema.fields[start:start + COLUMNS_PER_PASS]):
                column = F.col(f"`{field.name}`")
                cells = [F.lit(field.name).alias(FEATURE)]
                if self.getCounts():
                    aggregates.append(F.approx_count_distinct(column).alias(f"d{i}"))
                    cells.append(F.col(f"d{i}").alias("distinct"))
                if probabilities:
                    quantiles = F.lit(None).cast("array<double>")
                    if is_numeric(field.dataType):
                        accuracy = max(1, int(round(1.0 / self.getErrorThreshold())))
                        aggregates.append(F.percentile_approx(
                            no_nan(column, field.dataType).cast("double"),
                            F.array(*[F.lit(p) for p in probabilities]), F.lit(accuracy)
                        ).alias(f"q{i}"))
                        quantiles = F.col(f"q{i}")
                    cells.append(quantiles.alias("quantiles"))
                rows.append(F.struct(*cells))
            one = df.agg(*aggregates) if aggregates else df.agg(F.count(F.lit(1)))
            part = one.select(F.inline(F.array(*rows)))
            out = part if out is None else out.unionByName(part)
        return out

    def _assemble(self, df, table, probabilities, exact) -> DataFrame:
        """Cells in the order of the result; columns that are no numbers get NaN."""
        numeric = [f.name for f in df.schema if is_numeric(f.dataType)]
        nan = F.lit(float("nan"))
        is_number = F.col(FEATURE).isin(numeric) if numeric else F.lit(False)
        if exact:
            known = F.create_map(*[x for name in numeric for x in (
                F.lit(name), F.array(*[F.lit(v).cast("double") for v in exact[name]]))])
            quantiles = F.try_element_at(known, F.col(FEATURE))
        else:
            quantiles = F.col("quantiles") if probabilities else None
        cells = [F.col(FEATURE)]
        if self.getCounts():
            cells += [c.cast("double").alias(n) for c, n in zip(
                (F.col("present"), F.col("distinct"), F.col("total") - F.col("present")),
                COUNT_FIELDS)]
        position = 0
        if self.getBasic():
            cells += [F.when(is_number, quantiles[i]).otherwise(nan).alias(n)
                      for i, n in enumerate(BASIC_FIELDS)] if quantiles is not None else \
                     [nan.alias(n) for n in BASIC_FIELDS]
            position = len(BASIC_FIELDS)
        if self.getSample():
            moments = (F.col("variance"), F.sqrt("variance"), F.col("skewness"), F.col("kurtosis"))
            cells += [F.when(is_number, m).otherwise(nan).alias(n)
                      for m, n in zip(moments, SAMPLE_FIELDS)]
        if self.getPercentiles():
            cells += [F.when(is_number, quantiles[position + i]).otherwise(nan).alias(n)
                      for i, n in enumerate(PERCENTILE_FIELDS)] if quantiles is not None else \
                     [nan.alias(n) for n in PERCENTILE_FIELDS]
        return table.select(*cells)


def summarize(df: DataFrame, **options) -> DataFrame:
    return SummarizeData(**options).transform(df)
