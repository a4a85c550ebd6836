"""A partitioned Parquet table that batches are merged into by key.

    <path>/data/__commit=<name>/<partition>=<value>/*.parquet   rows, written beside what is there
    <path>/manifest/<name>                                      (partition, __commit): where each partition stands
    <path>/ledger/<number>.json                                 the commits, in order

A batch is reduced to the newest row of each key, joined by the rows that its partitions hold already, reduced
again, and written as a new folder.  The commit is one small file that is renamed into the ledger: a reader
follows the last one, and whatever a run that died has left behind is in no manifest.  The ledger also holds
the last batch of each stream, so that one that is replayed after a crash is skipped; one that comes again from
another run changes nothing, since its rows are no newer than those that stand.

A batch rewrites the partitions for which it has rows that do not stand there yet, and reads no others than it
names (dynamic partition pruning on the manifest): to apply one again costs a read and no write.
One writer at a time: the second of two commits with one number fails, and its stream tries again.

Cases: rows of one key and version: the one with the larger hash of all columns stays, in any order of arrival;
null keys, versions and partitions are values like others, null versions being the oldest; a key must keep its
partition; columns of map type cannot be compared and fail; an empty batch is committed without rows; a table without commits is empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfloom.streaming import files

COMMIT = "__commit"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], version: list[str], partition: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.version, self.partition = keys, version, partition

    def last(self) -> tuple[int, dict]:
        """Number and content of the last commit; 0 and nothing before the first."""
        found = [n for n in files.names(self.spark, f"{self.path}/ledger") if n.endswith(".json") and not n.startswith(".")]
        return (int(found[-1].split(".")[0]), files.get(self.spark, f"{self.path}/ledger/{found[-1]}")) if found else (0, {})

    def _manifest(self, commit: dict) -> DataFrame:
        kind = T.StructType([self.schema[self.partition], T.StructField(COMMIT, T.StringType())])
        if not commit:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(f"{self.path}/manifest/{commit['name']}")

    def _live(self, commit: dict) -> set[str]:
        """The commits that still hold a partition: no more than partitions."""
        return {r[0] for r in self._manifest(commit).select(COMMIT).distinct().collect()}

    def _rows(self, commit: dict) -> DataFrame:
        # Folders that only earlier commits need are not even listed.
        live = sorted(self._live(commit)) if commit else []
        if not live:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField(COMMIT, T.StringType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{COMMIT}={name}" for name in live])
        at = self._manifest(commit).select(F.col(self.partition).alias("__p"), F.col(COMMIT).alias("__c"))
        here = rows.join(at, (F.col(COMMIT) == F.col("__c")) & F.col(self.partition).eqNullSafe(F.col("__p")), "left_semi")
        return here.select(*self.schema.fieldNames())

    def read(self) -> DataFrame:
        """The rows of the last commit."""
        return self._rows(self.last()[1])

    def _newest(self, rows: DataFrame) -> DataFrame:
        # Nulls count as values; nested ones are hashed as text, which keeps their places.
        nested = (T.StructType, T.ArrayType)
        parts = [F.to_json(F.struct(f.name)) if isinstance(f.dataType, nested) else F.col(f.name) for f in self.schema.fields]
        tie = F.xxhash64(*parts, *[F.col(f.name).isNull() for f in self.schema.fields])
        by = list(dict.fromkeys([self.partition, *self.keys]))
        order = Window.partitionBy(*by).orderBy(*[F.col(c).desc_nulls_last() for c in self.version], tie.desc())
        return rows.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")

    def _touched(self, new: DataFrame, commit: dict) -> DataFrame:
        """The partitions for which ``new`` has rows that do not stand there yet."""
        if not commit:
            return new.select(self.partition).distinct()
        named = new.select(F.col(self.partition).alias("__t")).distinct()
        there = self._rows(commit).join(named, F.col(self.partition).eqNullSafe(F.col("__t")), "left_semi")
        return new.subtract(there).select(self.partition).distinct()

    def merge(self, batch: DataFrame, batch_id: int | None = None, stream: str = "") -> bool:
        """Merges a batch; False if the ledger has it already."""
        number, commit = self.last()
        if batch_id is not None and batch_id <= commit.get("streams", {}).get(stream, -1):
            return False
        name = f"{number + 1:012d}-{uuid.uuid4().hex}"
        new = batch.select(*self.schema.fieldNames())
        # Which partitions change is found once and written: the rows and the rest of the manifest follow it.
        changed = f"{self.path}/manifest/{name}"
        self._touched(new, commit).withColumn(COMMIT, F.lit(name)).coalesce(1).write.parquet(changed)
        p = self._manifest({"name": name}).select(F.col(self.partition).alias("__t"))
        same = F.col(self.partition).eqNullSafe(F.col("__t"))
        if not p.isEmpty():
            merged = new.join(p, same, "left_semi")
            if commit:
                merged = merged.unionByName(self._rows(commit).join(p, same, "left_semi"))
            # A partition goes to one task; adaptive execution splits large ones.
            self._newest(merged).hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(f"{self.path}/data/{COMMIT}={name}")
        if commit:
            self._manifest(commit).join(p, same, "left_anti").coalesce(1).write.mode("append").parquet(changed)
        streams = commit.get("streams", {}) | ({stream: batch_id} if batch_id is not None else {})
        self.publish(number + 1, {"name": name, "streams": streams})
        return True

    def publish(self, number: int, commit: dict) -> None:
        files.put(self.spark, f"{self.path}/ledger/{number:012d}.json", commit, replace=False)

    def vacuum(self) -> list[str]:
        """Deletes folders that only earlier commits, or runs that died, have written; returns their names."""
        number, commit = self.last()
        if not commit:
            return []
        live = self._live(commit) | {commit["name"]}
        gone = []
        for folder, prefix in (("data", f"{COMMIT}="), ("manifest", "")):
            for n in files.names(self.spark, f"{self.path}/{folder}"):
                name = n.removeprefix(prefix)
                if name[:12].isdigit() and int(name[:12]) <= number and name not in (live if folder == "data" else {commit["name"]}):
                    files.remove(self.spark, f"{self.path}/{folder}/{n}")
                    gone.append(f"{folder}/{name}")
        return gone
