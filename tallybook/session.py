"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges small shuffle partitions at run time and splits hot
# join partitions; how many there are at first depends on the input, see ``build_session``. forceOptimizeSkewedJoin keeps that split even where it costs one
# more shuffle, because a hot reference is the usual failure in this workload.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


#: Shuffled bytes that a partition takes before adaptive execution merges small ones.
PARTITION_BYTES = 64 << 20
LEAST_PARTITIONS = 200


def first_partitions(input_bytes: int) -> int:
    """Shuffle partitions to start with for an input of this size.

    Adaptive execution merges partitions but adds none, so the number must suit
    the input before anything runs. It is at most 100,000, which a driver can
    still keep track of: a gigabyte each if all of 100 TB is shuffled, sorted on disk.
    """
    return max(LEAST_PARTITIONS, min(100_000, -(-input_bytes // PARTITION_BYTES)))


def build_session(
    app: str = "tallybook",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Create or fetch a session; ``conf`` overrides the settings above.

    ``input_bytes``: size of the tables to be read; it sets the number of shuffle
    partitions that adaptive execution starts from.
    """
    if input_bytes is not None:
        first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        conf = {first: str(first_partitions(input_bytes)), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
