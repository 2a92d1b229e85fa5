"""Vector columns as arrays."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def elements(vector: Column | str, dtype: str = "float64") -> Column:
    """Array of a vector's elements; a null vector gives null instead of an error."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.when(column.isNotNull(), vector_to_array(column, dtype))
