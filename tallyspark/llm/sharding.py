"""Size-tiered shards under a versioned manifest, with DataFrame operations only.

Arrivals are appended as small immutable Parquet files, the shards. Compaction
merges runs of similarly sized shards into files of a target size. Each change
writes its files first, then the next version of the manifest, and commits by
renaming a file that names it to the version's own name, which fails where that
is taken: a reader sees the old version or the new one, one of two writers wins,
and a lost job leaves nothing but unlisted files.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import remove_path, shared_path

TARGET_BYTES = 128 << 20
#: Shards of a tier differ by less than this factor; so many shards of one tier are merged.
RATIO, FAN_IN = 4, 4
ROWS_A_SHARD = 2000
BASE_BYTES = 64 << 10

_MANIFEST = "path string, bytes long, rows long, tier int, rows_schema string"


class CommitConflict(RuntimeError):
    """Another writer has committed this version first."""


class ShardStore:
    """A folder of shards and manifests; ``version`` 0 is the empty store."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES):
        self.spark, self.root, self.target_bytes = spark, root.rstrip("/"), target_bytes

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def version(self) -> int:
        """The latest committed version."""
        fs = self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(self._path("manifest")):
            return 0
        names = [x.getPath().getName() for x in fs.listStatus(self._path("manifest"))]
        return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """path, bytes, rows and tier of each shard."""
        return self._rows(version).filter(F.col("path").isNotNull()).drop("rows_schema")

    def _rows(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/{self._named(version)}")

    def _named(self, version: int) -> str:
        """The folder of a version's manifest, as its commit says."""
        path = self._path(f"manifest/v{version:08d}")
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(path)
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def _commit(self, shards: DataFrame, schema: T.StructType, version: int) -> int:
        """Publishes ``shards`` as ``version``; its first row carries the schema of the data."""
        head = self.spark.range(1).select(F.lit(None).cast("string").alias("path"), *[F.lit(0).cast(t).alias(c) for c, t in (("bytes", "long"), ("rows", "long"), ("tier", "int"))])
        rows = head.unionByName(shards).withColumn("rows_schema", F.when(F.col("path").isNull(), F.lit(schema.json())))
        name = f"manifests/{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(f"{self.root}/{name}")  # a row for each shard
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        fs = self._path("").getFileSystem(conf)
        fs.mkdirs(self._path("manifest"))
        staged, target = self._path(f"{name}.commit"), self._path(f"manifest/v{version:08d}")
        stream = fs.create(staged, False)
        stream.writeUTF(name)
        stream.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:  # fails, unlike FileSystem.rename, where the target is there
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(
                fs.makeQualified(staged), fs.makeQualified(target), self.spark.sparkContext._gateway.new_array(kind, 0)
            )
        except Py4JJavaError as error:
            if fs.exists(staged):
                fs.delete(staged, False)
            if not fs.exists(target):
                raise
            raise CommitConflict(f"version {version} of {self.root} is there already") from error
        if self._named(version) != name:
            raise CommitConflict(f"version {version} of {self.root} is another writer's")
        return version

    def _shards(self, folder: str) -> DataFrame:
        """A manifest row for each file with rows under ``folder``."""
        found = self.spark.read.parquet(f"{self.root}/{folder}").select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("bytes"))
        counted = found.groupBy("p", "bytes").agg(F.count("*").alias("rows"))
        size = F.greatest(F.col("bytes") / BASE_BYTES, F.lit(1.0))
        return counted.select(
            F.regexp_extract("p", r"([^/]+/[^/]+/[^/]+)$", 1).alias("path"), "bytes", "rows", F.floor(F.log(float(RATIO), size)).cast("int").alias("tier")
        )

    def append(self, rows: DataFrame, rows_a_shard: int = ROWS_A_SHARD) -> int:
        """Adds ``rows`` as new shards, where they lie: no shuffle.

        Any columns and values go in as they are; an empty table adds a version
        without new shards.
        """
        before = self.version()
        folder = f"data/v{before + 1:08d}-{uuid.uuid4().hex[:8]}"
        rows.write.option("maxRecordsPerFile", rows_a_shard).parquet(f"{self.root}/{folder}")
        return self._commit(self.manifest(before).unionByName(self._shards(folder)), rows.schema, before + 1)

    def compact(self, fan_in: int = FAN_IN) -> int:
        """Merges tiers of ``fan_in`` or more shards under the target size until there are none; the version then.

        A round merges each full tier at once into as many files as its bytes
        ask for, by joining partitions of the scan: no shuffle. Each round
        leaves fewer shards, so it ends. An empty store stays as it is; rows
        come through as they are, repeated ones and nulls too.
        """
        while True:
            before = self.version()
            shards = self.manifest(before)
            small = shards.filter(F.col("bytes") < self.target_bytes)
            tiers = self._full(small, fan_in)
            if not tiers:
                return before
            schema = self.schema(before)
            merged, folders = [], []
            for t in sorted(tiers, key=lambda t: t["tier"]):
                run = small.filter(F.col("tier") == t["tier"]).orderBy("path").select("path").toLocalIterator()
                folder = f"data/v{before + 1:08d}-{uuid.uuid4().hex[:8]}"
                files = max(1, -(-t["bytes"] // self.target_bytes))
                self._read([r["path"] for r in run], schema).coalesce(files).write.parquet(f"{self.root}/{folder}")
                folders.append(folder)
                merged.append(t["tier"])
            rest = shards.filter(~(F.col("tier").isin(merged) & (F.col("bytes") < self.target_bytes)))
            for folder in folders:
                rest = rest.unionByName(self._shards(folder))
            self._commit(rest, schema, before + 1)

    def _full(self, small: DataFrame, fan_in: int) -> list:
        """Tiers with shards enough to merge into fewer: a few rows, one a tier."""
        tiers = small.groupBy("tier").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).filter(F.col("n") >= fan_in).collect()
        return [t for t in tiers if -(-t["bytes"] // self.target_bytes) < t["n"]]

    def full_tiers(self, fan_in: int = FAN_IN) -> int:
        """Tiers that compaction would merge."""
        return len(self._full(self.manifest().filter(F.col("bytes") < self.target_bytes), fan_in))

    def schema(self, version: int | None = None) -> T.StructType:
        row = self._rows(version).filter(F.col("path").isNull()).first()
        return T.StructType.fromJson(json.loads(row["rows_schema"])) if row else T.StructType([])

    def _read(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, as they were put in; version 0 has none, and no columns.

        The driver holds the list of the version's files, as it does for any table that Spark reads.
        """
        version = self.version() if version is None else version
        return self._read([r["path"] for r in self.manifest(version).select("path").toLocalIterator()], self.schema(version))

    def vacuum(self) -> None:
        """Removes data files that the latest version doesn't list; older versions can't be read any more."""
        live = {r["path"] for r in self.manifest().select("path").toLocalIterator()}
        fs = self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(self._path("data")):
            return
        for folder in fs.listStatus(self._path("data")):
            name = folder.getPath().getName()
            for f in fs.listStatus(folder.getPath()):
                if f"data/{name}/{f.getPath().getName()}" not in live:
                    fs.delete(f.getPath(), True)


def shard_documents(docs: DataFrame, target_bytes: int = TARGET_BYTES, root: str | None = None) -> tuple[ShardStore, DataFrame]:
    """A compacted store of ``docs`` and its rows with the shard each is in.

    The rows come back from the committed shards as they were put in: nulls,
    empty and very long texts and repeated rows included, with all columns, and
    ``shard`` (version folder, file) and ``shard_bytes``, which replace columns
    of the same name. An empty table makes an empty store.
    """
    spark = docs.sparkSession
    store = ShardStore(spark, root or shared_path(spark, "shards"), target_bytes)
    store.append(docs.drop("shard", "shard_bytes"))
    store.compact()
    store.vacuum()
    rows = store.read()
    if not rows.inputFiles():
        return store, rows.withColumns({"shard": F.lit("").cast("string"), "shard_bytes": F.lit(0).cast("long")})
    name = F.regexp_extract("_metadata.file_path", r"/(v[0-9]+)-[^/]*/part-([0-9]+)-.*-c([0-9]+)", 1)
    part, file = (F.regexp_extract("_metadata.file_path", r"/(v[0-9]+)-[^/]*/part-([0-9]+)-.*-c([0-9]+)", k) for k in (2, 3))
    return store, rows.withColumns({"shard": F.concat_ws("-", name, part, file), "shard_bytes": F.col("_metadata.file_size")})
