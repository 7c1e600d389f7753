"""Writers: only what changed, merges with what is there, partitions by key, append-only ledgers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import prefer, refresh

#: Columns that say when a row was made, not what it says.
STAMPS = ("generated_at",)


def row_hash(df: DataFrame, stamps: tuple[str, ...] = STAMPS):
    return F.xxhash64(F.to_json(F.struct(*sorted(c for c in df.columns if c not in stamps))))


def changed_partitions(old: DataFrame, new: DataFrame, by: str, stamps: tuple[str, ...] = STAMPS) -> DataFrame:
    """Values of ``by`` whose rows differ between the two, order and stamps aside."""

    def summed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(by).agg(F.struct(F.count("*").alias("n"), F.sum(row_hash(df, stamps).cast("decimal(38,0)")).alias("h")).alias(name))

    j = summed(old, "a").join(summed(new, "b"), by, "full")
    return j.filter(~F.col("a").eqNullSafe(F.col("b"))).select(by)


def write_changed(new: DataFrame, path: str, by: str, stamps: tuple[str, ...] = STAMPS) -> int:
    """Overwrites the partitions of ``path`` that changed and leaves the others as they are; how many did."""
    spark = new.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        new.write.partitionBy(by).parquet(path)
        return new.select(by).distinct().count()
    old = spark.read.schema(new.schema).parquet(path)
    changed = changed_partitions(old, new, by, stamps)
    n = changed.count()
    if n:
        rows = new.join(changed, by, "left_semi")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return n


def merge_write(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows kept, this run's replace those of the same keys."""
    return prefer([new, old], keys)


def partial_refresh(fresh: DataFrame, old: DataFrame, key: str) -> DataFrame:
    return refresh(old, fresh, key)


def sharded(rows: DataFrame, key: str) -> DataFrame:
    """Rows with ``shard``: the first letter of the key, # for others."""
    first = F.upper(F.substring(key, 1, 1))
    return rows.withColumn("shard", F.when(first.rlike("^[A-Z]$"), first).otherwise("#"))


def append_ledger(entries: DataFrame, path: str, reasons: list[str]) -> None:
    """Appends entries with a known reason; one without is an error, and nothing is written."""
    checked = entries.withColumn("reason", F.when(F.col("reason").isin(reasons), F.col("reason")).otherwise(F.raise_error(F.lit("unknown reason"))))
    checked.write.mode("append").json(path)


def ledger_summary(entries: DataFrame) -> DataFrame:
    return entries.groupBy("reason").agg(F.count("*").alias("n"), F.max("day").alias("last"))


def markdown_table(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """One row: the rows as a Markdown table in a stated order, bars escaped. For reports of bounded length."""
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    packed = rows.select(F.struct(*order, line.alias("line")).alias("r")).agg(F.array_sort(F.collect_list("r")).alias("rs"))
    head = f"| {' | '.join(columns)} |\n|{'---|' * len(columns)}"
    return packed.select(F.concat_ws("\n", F.lit(head), F.array_join(F.transform("rs", lambda r: r["line"]), "\n")).alias("table"))


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def refresh_quarters(rows: DataFrame, path: str, running: str) -> DataFrame:
    """Rows by ``quarter``: those that the cache at ``path`` holds are served from it, the running one and new ones are written.

    Returns the cache's rows after that; the running quarter is always replaced.
    """
    spark = rows.sparkSession
    fs, jpath = _fs(spark, path)
    if fs.exists(jpath):
        held = spark.read.schema(rows.schema).parquet(path).select("quarter").distinct().filter(F.col("quarter") != running)
        rows = rows.join(F.broadcast(held), "quarter", "left_anti")  # one row a quarter
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("quarter").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def index_and_years(positions: DataFrame, path: str, manager: str, security: str, quarter: str, value: str, top: int = 25) -> tuple[DataFrame, DataFrame]:
    """Writes positions as files a manager and year, an index of the ``top`` largest of each quarter, and series of all that ever were; gives (index, series).

    Quarters are text that begins with the year. Ties go to the lesser security. Large managers and years are split over tasks, small ones share them.
    """
    ranked = positions.withColumn("rank", F.row_number().over(Window.partitionBy(manager, quarter).orderBy(F.desc(value), F.col(security))))
    spark = positions.sparkSession
    ranked.withColumn("year", F.substring(quarter, 1, 4)).hint("rebalance", manager, "year").write.mode("overwrite").partitionBy(manager, "year").parquet(f"{path}/years")
    schema = ranked.withColumn("year", F.lit("")).schema
    back = spark.read.schema(schema).parquet(f"{path}/years").drop("year")
    back.filter(F.col("rank") <= top).write.mode("overwrite").parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    notable = index.select(manager, security).distinct()
    return index, back.drop("rank").join(notable, [manager, security], "left_semi")


def publish(df: DataFrame, root: str) -> str:
    """Writes a version of a table under ``root`` and makes it the current one by replacing one small file, so readers see the old one or the new."""
    version = uuid.uuid4().hex
    df.write.parquet(f"{root}/{version}")
    return _make_current(df.sparkSession, root, version)


def publish_together(tables: dict[str, DataFrame], root: str) -> str:
    """Writes tables as one version under ``root``: readers see all of the old ones or all of the new, whatever fails in between."""
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.parquet(f"{root}/{version}/{name}")
        spark = df.sparkSession
    return _make_current(spark, root, version)


def _make_current(spark: SparkSession, root: str, version: str) -> str:
    fs, staged = _fs(spark, f"{root}/_current-{version}")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_current")
    stream = fs.create(staged)
    stream.writeUTF(version)
    stream.close()
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(staged), fs.makeQualified(target), how)
    return version


def published(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """The current version of a table that ``publish`` wrote, or of the one of that name that ``publish_together`` wrote."""
    fs, target = _fs(spark, f"{root}/_current")
    stream = fs.open(target)
    version = stream.readUTF()
    stream.close()
    return spark.read.parquet(f"{root}/{version}/{name}" if name else f"{root}/{version}")
