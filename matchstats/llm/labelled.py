"""Bounded samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sampled_ids(labelled: DataFrame, label: str, per_class: int, classes: int) -> list[tuple]:
    """(doc_id, label) of at most ``per_class`` rows of each of the ``classes`` commonest labels.

    Rows are taken in the order of a hash of their id, so every row is as likely and the
    sample depends on the rows only. Nothing but the sample, ``per_class * classes`` ids,
    reaches the driver.
    """
    rows = labelled.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(classes).collect()
    sample = []
    for row in counts:
        of_class = rows.where(F.col(label) == row[label]).select("doc_id").distinct()
        nearest = of_class.orderBy(F.xxhash64(F.lit(label), "doc_id"), "doc_id").limit(per_class)
        sample += [(r["doc_id"], row[label]) for r in nearest.collect()]
    return sample
