"""Array and comma-list expressions."""

from pyspark.sql import functions as F


def split_names(text):
    """Trimmed, non-empty entries of a comma list, in order."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def lag_names(lists):
    """Sorted distinct lags of an array of lag lists, as column names."""
    lags = F.array_sort(F.array_distinct(F.flatten(lists)))
    return F.transform(lags, lambda x: F.concat(F.lit("lag_"), x.cast("string")))
