"""Small counts kept beside a build: what a table's days hold, without reading the days.

Per day: rows, a hash of their content that doesn't depend on their order, and, where no
grain key can occur on two days, how many keys there are, how many repeat and how often
one does at most.  Where keys cross days, the count of each key and day is kept instead;
such counts merge by adding them up.  A report reads these counts of the builds that the
current snapshot names, and a rebuild counts only the days that it made.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import files
from ledgerline.operators.snapshots import WHOLE, Snapshot

DAYS = "day date, rows bigint, content string, keys bigint, repeated bigint, most bigint"
KEYS = "day date, key string, n bigint"
# A table is the same if it has been loaded again with the same values.
NOT_CONTENT = {"loaded_at"}


def keep(
    rows: DataFrame, path: str, build: str, time_column: str | None, grain: tuple[str, ...]
) -> None:
    """Count the ``rows`` of a build and write the counts beside it."""
    day = F.lit(None).cast("date") if time_column is None else F.col(time_column).cast("date")
    values = [F.col(name) for name in rows.columns if name not in NOT_CONTENT]
    hashed = F.sum(F.xxhash64(*values).cast("decimal(38,0)"))
    keyed = rows.select("*", day.alias("state_day"))
    # Sums by day come apart from keys: a key is sent with its count, and nothing else.
    counts = keyed.groupBy(F.col("state_day").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), hashed.cast("string").alias("content")
    )
    per_key = keyed.groupBy("state_day", *grain).agg(F.count(F.lit(1)).alias("n"))
    names = ("keys", "repeated", "most")
    if time_column is None or time_column in grain:
        of_keys = per_key.groupBy(F.col("state_day").alias("key_day")).agg(
            F.count(F.lit(1)).alias("keys"),
            F.count(F.when(F.col("n") > 1, 1)).alias("repeated"),
            F.max("n").alias("most"),
        )
        counts = counts.join(of_keys, F.col("day").eqNullSafe(F.col("key_day"))).drop("key_day")
    else:
        key = F.to_json(F.struct(*grain), {"ignoreNullFields": "false"})
        by_key = per_key.select(F.col("state_day").alias("day"), key.alias("key"), "n")
        by_key.write.option("compression", "zstd").parquet(f"{path}/_keys/build={build}")
        nothing = F.lit(None).cast("bigint")
        counts = counts.withColumns({name: nothing for name in names})
    counts.coalesce(1).write.parquet(f"{path}/_states/build={build}")


def _of(spark: SparkSession, path: str, kind: str, schema: str, snapshot: Snapshot) -> DataFrame:
    """Counts of just the days that a snapshot takes from each build."""
    home = f"{path}/{kind}"
    folders = [f"{home}/build={b}" for b in sorted(set(snapshot.builds.values()))]
    folders = [folder for folder in folders if files.exists(spark, folder)]
    if not folders:
        return spark.createDataFrame([], schema)
    # One row per day of the table.
    named = spark.createDataFrame(
        [(None if d == WHOLE else date.fromisoformat(d), b) for d, b in snapshot.builds.items()],
        "day date, build string",
    )
    read = spark.read.schema(f"{schema}, build string").option("basePath", home)
    same = F.col("s.day").eqNullSafe(F.col("d.day")) & (F.col("s.build") == F.col("d.build"))
    rows = read.parquet(*folders).alias("s").join(F.broadcast(named).alias("d"), same, "left_semi")
    return rows.drop("build")


def of_days(spark: SparkSession, path: str, snapshot: Snapshot) -> DataFrame:
    return _of(spark, path, "_states", DAYS, snapshot)


def grain_of(spark: SparkSession, path: str, snapshot: Snapshot) -> DataFrame:
    """One row: ``grain_keys``, ``repeated_keys`` and ``most_rows_per_key``."""
    zero = F.lit(0).cast("bigint")
    across = _of(spark, path, "_keys", KEYS, snapshot)
    if across.isEmpty():
        days = of_days(spark, path, snapshot)
        counts = days.agg(F.sum("keys"), F.sum("repeated"), F.max("most"))
    else:
        per_key = across.groupBy("key").agg(F.sum("n").alias("n"))
        counts = per_key.agg(
            F.count(F.lit(1)), F.count(F.when(F.col("n") > 1, 1)), F.max("n")
        )
    counts = counts.toDF("grain_keys", "repeated_keys", "most_rows_per_key")
    return counts.select(*[F.coalesce(F.col(c), zero).alias(c) for c in counts.columns])


def changed_days(spark: SparkSession, path: str, before: Snapshot, after: Snapshot) -> list[date | None]:
    """Days whose content differs between two snapshots; null for a whole table.

    At most one row per day of the table.
    """
    old, new = (
        of_days(spark, path, s).select("day", "rows", "content") for s in (before, after)
    )
    differs = old.exceptAll(new).unionByName(new.exceptAll(old))
    return [row["day"] for row in differs.select("day").distinct().orderBy("day").collect()]
