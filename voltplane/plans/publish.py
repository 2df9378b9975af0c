"""Published tables: partitioned by order and run, written again without duplicates, widened where types grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import safe_column

PARTITIONS = ("order_id", "run_key")
#: From narrow to wide; two types meet at the first of these that holds both.
_WIDTH = ["boolean", "int", "bigint", "double", "string"]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both without loss of meaning: the same type, a wider number, else text."""
    if a == b:
        return a
    names = [x.simpleString() for x in (a, b)]
    if all(n in _WIDTH[1:4] for n in names):
        return max((a, b), key=lambda x: _WIDTH.index(x.simpleString()))
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    fields = {f.name: f.dataType for f in a}
    for f in b:
        fields[f.name] = wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with the columns and types of the schema; what it lacks is null."""
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def tidy(df: DataFrame, key: dict[str, str]) -> DataFrame:
    """Safe, distinct column names with the key's columns first."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        name = safe_column(c)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    out = df.toDF(*names)
    return out.select(*[F.lit(v).alias(k) for k, v in key.items()], *[c for c in names if c not in key])


class Store:
    """Run-keyed Parquet tables below a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        fs, path = self._files(name)
        if fs.exists(path):
            return True
        aside, old = self._files(f"_{name}_old")
        return aside.exists(old) and self._rename(f"_{name}_old", name)

    def read(self, name: str, where: str | None = None) -> DataFrame | None:
        if not self.exists(name):
            return None
        df = self.spark.read.option("mergeSchema", "true").parquet(self.path(name))
        return df.where(where) if where else df

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Replaces the rows of the runs that `rows` holds, and no others. If a column grew to a wider type, the table is rewritten first."""
        missing = [c for c in PARTITIONS if c not in rows.columns]
        if missing:
            raise ValueError(f"{name} lacks {missing}")
        if self.exists(name):
            old = self.read(name)
            for c in PARTITIONS:
                old = old.withColumn(c, F.col(c).cast("string"))
            schema = common_schema(old.schema, rows.schema)
            if [old.schema[f.name].dataType for f in schema if f.name in old.columns] != [f.dataType for f in schema if f.name in old.columns]:
                self._rewrite(name, aligned(old, schema))
            rows = aligned(rows, schema)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(self.path(name))

    def _rewrite(self, name: str, rows: DataFrame) -> None:
        """Swaps the table for the rows: the old one stays aside until the new one stands, and `read` takes it back if a crash came between."""
        rows.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(self.path(f"_{name}_new"))
        for a, b in ((name, f"_{name}_old"), (f"_{name}_new", name)):
            if not self._rename(a, b):
                raise OSError(f"can't rename {self.path(a)} to {self.path(b)}")
        self._delete(f"_{name}_old")
        self.spark.catalog.refreshByPath(self.path(name))

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _rename(self, a: str, b: str) -> bool:
        fs, path = self._files(a)
        return fs.rename(path, self._files(b)[1])

    def _delete(self, name: str) -> None:
        fs, path = self._files(name)
        fs.delete(path, True)

    def publish(self, key: dict[str, str], tables: dict[str, DataFrame], record: DataFrame) -> list[str]:
        """All result tables, then the row of `runs`: a run is there only once its results are."""
        for name, df in tables.items():
            self.upsert(name, tidy(df, key))
        self.upsert("runs", tidy(record, key))
        return [*tables, "runs"]

    def delete_run(self, run_key: str, names: list[str]) -> list[str]:
        """Drops a run's partitions; the `runs` row goes first."""
        gone = []
        for name in sorted(names, key=lambda n: n != "runs"):
            df = self.read(name)
            if df is None:
                continue
            jvm = self.spark._jvm
            for row in df.where(F.col("run_key") == run_key).select(*PARTITIONS).distinct().collect():
                escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
                path = jvm.org.apache.hadoop.fs.Path("/".join([self.path(name), *(f"{c}={escaped(str(row[c]))}" for c in PARTITIONS)]))
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
                gone.append(name)
        return gone

    def runs(self) -> DataFrame | None:
        df = self.read("runs")
        return None if df is None else df.orderBy(F.desc("published"))


def plan(found: DataFrame, published: DataFrame, key: str, digest: str = "digest", most: int | None = None) -> DataFrame:
    """The found runs with `action`: new, changed (another digest) or skip; with `most`, only so many that are to be run."""
    known = published.select(key, F.col(digest).alias("_known"), F.lit(True).alias("_there"))
    out = found.join(known, key, "left")
    out = out.withColumn("action", F.when(F.col("_there").isNull(), "new").when(~F.col(digest).eqNullSafe(F.col("_known")), "changed").otherwise("skip")).drop("_known", "_there")
    return out if most is None else out.where("action <> 'skip'").orderBy(key).limit(most)


def write_json(rows: DataFrame, path: str) -> None:
    """Results as JSON lines, one file a task; columns that are null in a row are written as null."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)
