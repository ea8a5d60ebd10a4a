"""Use all cores for expensive per-row work on an input of few partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Repartition a scan by a unique key, but only if it has fewer partitions than cores.

    A single file, or a file with one row group, would leave most of the cluster idle
    while one task cleans all texts. A scan with a partition for every core is left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.isStreaming or scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)
