"""What the library needs of a running session."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()
_own_dirs: dict[str, str] = {}


#: A key that more than this share of all rows hold is heavy, so there are fewer heavy keys than its inverse and a table of them is small; one
#: of fewer rows than the other number never is.
HEAVY_SHARE, HEAVY_ROWS = 1 / 100_000, 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset and all run on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return _own_dirs[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """The table written to the shared folder and read back: what uses it several times computes it once, and a lost executor costs a read."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, tag: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """The table written to the shared folder in buckets of ``keys`` and read back. Tables with as many buckets of the same keys are joined and
    grouped by them (and by more columns) where they lie, without an exchange.

    There is a file for each bucket, and a bucket is one task's, so the number of buckets (the session's shuffle partitions by default) has to
    grow with the data, and no key may hold many rows. The session's catalogue knows the table only while it is written."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = scratch_path(spark, tag), f"written_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # of an external table this leaves the files
    return table


def join_counted(rows: DataFrame, table: DataFrame, keys: str | list[str], count: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for every key in ``rows`` and says in ``count`` how many rows hold it.

    Heavy keys, a hundred thousand at most whatever the data, are broadcast and joined where their rows are; only the others are shuffled, so
    one key brings a task no more than ``HEAVY_ROWS`` rows, or ten million of a trillion. Rows with a null in a key are left out. Both are read twice if there are heavy
    keys, and should be stored tables."""
    keys = [keys] if isinstance(keys, str) else keys
    total, largest = table.agg(F.sum(count), F.max(count)).first()
    bound = max((total or 0) * HEAVY_SHARE, HEAVY_ROWS)
    if (largest or 0) <= bound:
        return rows.join(table, keys)
    heavy, light = table.where(F.col(count) > bound), table.where(F.col(count) <= bound)
    there = rows.join(F.broadcast(heavy), keys)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys)
    return there.unionByName(rest)


def look_up(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``join_counted`` by one key that keeps rows whose key is null or missing in ``table``: those are spread by their other columns."""
    total, largest = table.agg(F.sum(count), F.max(count)).first()
    bound, new = max((total or 0) * HEAVY_SHARE, HEAVY_ROWS), [c for c in table.columns if c not in (key, count)]
    open_, done = F.col(key).isNotNull(), rows
    if (largest or 0) > bound:
        heavy = table.where(F.col(count) > bound).select(key, F.lit(True).alias("__heavy"), *(F.col(c).alias(f"__{c}") for c in new))
        done, open_ = rows.join(F.broadcast(heavy), key, "left"), open_ & F.col("__heavy").isNull()
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(1024))
    done = done.withColumns({"__key": F.when(open_, F.col(key)), "__spread": F.when(open_, 0).otherwise(spread)})
    light = table.where(F.col(count) <= bound).select(F.col(key).alias("__key"), F.lit(0).cast("long").alias("__spread"), *new)
    done = done.join(light, ["__key", "__spread"], "left")
    return done.select(*rows.columns, *(F.coalesce(f"__{c}", c).alias(c) if (largest or 0) > bound else F.col(c) for c in new))


def split_crowded(a: DataFrame, b: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both tables with ``keys`` and, where a key has more than ``most`` rows in ``a`` (a stored table), a part: its rows in ``a`` are dealt to
    parts of about ``most``, and its rows in ``b`` go to each of them. Returns the tables and the keys to group or join them by.

    Crowded keys are broadcast; as few as a hundred thousand can be, since ``most`` rises to that share of all rows."""
    counts = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total, largest = counts.agg(F.sum("__n"), F.max("__n")).first()
    most = max(most, int((total or 0) * HEAVY_SHARE))
    if (largest or 0) <= most:
        return a, b, keys
    part = f"__part{len(keys)}"
    crowded = F.broadcast(counts.where(F.col("__n") > most).select(*keys, F.ceil(F.col("__n") / most).alias("__splits")))
    splits = F.coalesce("__splits", F.lit(1).cast("long"))
    own = [c for c in a.columns if c not in keys]
    dealt = a.join(crowded, keys, "left").withColumn(part, F.pmod(F.xxhash64(*own) if own else F.monotonically_increasing_id(), splits)).drop("__splits")
    copied = b.join(crowded, keys, "left").withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), splits - 1))).drop("__splits")
    return dealt, copied, [*keys, part]


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package, once for each application; a cluster that has it installed loses nothing."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "terrasheaf_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, Path(package.name) / path.relative_to(package))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
