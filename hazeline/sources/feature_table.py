"""Versioned feature tables as Parquet, in parts by day and bucket of cities.

Layout of `<root>/<name>/v<version>/`: `meta/` has the declared schema and keys, `data/commit=<label>/day=/bucket=` the
rows, `live/<label>` which commit holds each part, and `commits/<number>` the label of each commit in turn. An upsert
rewrites the parts it touches into a commit of its own and never a file that is there already; it counts once its number
is taken, which is one file created if it doesn't exist. A run that dies before leaves files that nobody reads.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.session import written
from hazeline.sources.files import between_days

INGESTED = "ingested_at"


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Folder entries, through the same file system layer Spark reads with."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def table_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    matches = (re.fullmatch(r"v(\d+)", entry) for entry in child_names(spark, f"{root}/{name}"))
    return sorted(int(m.group(1)) for m in matches if m)


BUCKETS = 4
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
Part = tuple[str, int]  # day, bucket


def utc_clock(instant: Column) -> Column:
    """The UTC clock of an instant, whatever the zone of the session; exact in hours that a zone repeats."""
    micros = F.unix_micros(instant)
    day = F.lit(86_400_000_000)
    whole = F.floor(micros / day).cast("int")
    rest = F.pmod(micros, day)
    seconds = (rest.cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(whole, F.lit(0), F.lit(0), seconds)


@dataclass
class FeatureTable:
    spark: SparkSession
    root: str
    name: str
    version: int
    schema: T.StructType
    primary_key: list[str]
    event_time: str
    counted: bool = False

    @property
    def path(self) -> str:
        return f"{self.root}/{self.name}/v{self.version}"

    @classmethod
    def get_or_create(cls, spark, root, name, version, schema=None, primary_key=("city", "date"), event_time="date", counted=False):
        """The table at exactly this version; created empty if it is not there. `counted` keeps rows per city and day."""
        if version in table_versions(spark, root, name):
            path = f"{root}/{name}/v{version}/meta"
            done = [m for m in sorted(child_names(spark, path)) if "_SUCCESS" in child_names(spark, f"{path}/{m}")]
            if done:
                meta = spark.read.json(f"{path}/{done[-1]}").first()
                stored = T.StructType.fromJson(json.loads(meta["schema"]))
                return cls(spark, root, name, version, stored, list(meta["primary_key"]), meta["event_time"], meta["counted"])
        if schema is None:
            raise ValueError(f"{name} v{version} does not exist and no schema was given")
        table = cls(spark, root, name, version, schema, list(primary_key), event_time, counted)
        table._write_meta()
        return table

    @classmethod
    def new_version(cls, spark, root, name, schema, primary_key=("city", "date"), event_time="date", counted=False):
        following = max(table_versions(spark, root, name), default=0) + 1
        return cls.get_or_create(spark, root, name, following, schema, primary_key, event_time, counted)

    def _write_meta(self) -> None:
        """The description in a folder of its own; the last finished one holds."""
        row = [(self.schema.json(), self.primary_key, self.event_time, self.counted)]
        meta = self.spark.createDataFrame(row, "schema string, primary_key array<string>, event_time string, counted boolean")
        number = len(child_names(self.spark, f"{self.path}/meta"))
        meta.coalesce(1).write.json(f"{self.path}/meta/{number:06d}")

    # ---- commits ----

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _label(self, number: int) -> str | None:
        files, path = self._file(f"commits/{number:012d}")
        stream = files.open(path)
        try:
            label = bytes(stream.readNBytes(32)).decode()
        finally:
            stream.close()
        return label if len(label) == 32 else None  # None: its writer died while taking the number

    def latest(self) -> tuple[int, dict[Part, str]]:
        """Number of the last commit, and the label that holds each part: one row for each day and bucket."""
        numbers = sorted((int(c) for c in child_names(self.spark, f"{self.path}/commits") if c.isdigit()), reverse=True)
        label = next((x for x in map(self._label, numbers) if x), None)
        rows = self.spark.read.schema("day string, bucket int, label string").parquet(f"{self.path}/live/{label}").collect() if label else []
        return (numbers[0] if numbers else 0), {(r["day"], r["bucket"]): r["label"] for r in rows}

    def _publish(self, number: int, label: str) -> bool:
        """Take a number; False if another writer has it."""
        files, path = self._file(f"commits/{number:012d}")
        try:
            stream = files.create(path, False)
        except Py4JJavaError:
            if files.exists(path):
                return False
            raise
        stream.write(bytearray(label.encode()))
        stream.close()
        return True

    # ---- rows ----

    def _parts(self, folder: str, fields: list[T.StructField], live: dict[Part, str]) -> DataFrame:
        """Rows of these parts; no part reads as no row."""
        full = T.StructType([*fields, T.StructField("commit", T.StringType()), T.StructField("day", T.DateType()), T.StructField("bucket", T.IntegerType())])
        paths = [f"{self.path}/{folder}/commit={label}/day={day or NO_DAY}/bucket={bucket}" for (day, bucket), label in live.items()]
        if not paths:
            return self.spark.createDataFrame([], full).drop("commit")
        return self.spark.read.schema(full).option("basePath", f"{self.path}/{folder}").parquet(*paths).drop("commit")

    def read(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Rows of the table as of now; a range reads the parts of its days only. Later upserts don't change them."""
        _, live = self.latest()
        if start is not None and end is not None:
            first, last = start[:10], end[:10]
            live = {part: label for part, label in live.items() if part[0] and first <= part[0] <= last}
            return between_days(self._rows(live), first, last, self.event_time).select(self.schema.names)
        return self._rows(live).select(self.schema.names)

    def _rows(self, live: dict[Part, str]) -> DataFrame:
        return self._parts("data", [*self.schema.fields, T.StructField(INGESTED, T.TimestampNTZType())], live)

    def counts(self) -> DataFrame:
        """(city, day, n): rows of each city and day, kept beside the rows of a `counted` table."""
        city = T.StructField(self.primary_key[0], self.schema[self.primary_key[0]].dataType)
        return self._parts("counts", [city, T.StructField("n", T.LongType())], self.latest()[1]).drop("bucket")

    def append_columns(self, fields: list[T.StructField]) -> None:
        """Declare more columns; rows written before read as null there."""
        known = set(self.schema.names)
        self.schema = T.StructType(self.schema.fields + [f for f in fields if f.name not in known])
        self._write_meta()

    def upsert(self, df: DataFrame) -> None:
        """Insert rows; a row with a known key replaces the stored one.

        Only the days and buckets present in `df` are read back and rewritten. Rows within the batch that share a key
        resolve to one, by content if they arrive together, so a repeated run leaves the same table. An event time with
        a zone becomes its UTC clock. If another writer commits meanwhile, the touched parts are read and written again.
        """
        kind = dict(df.dtypes)[self.event_time]
        key_date = utc_clock(F.col(self.event_time)) if kind == "timestamp" else F.col(self.event_time).cast("timestamp_ntz")
        # Written first: the batch is read twice and may be costly to compute.
        batch = written(
            df.withColumn(self.event_time, key_date)
            .select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                      else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields])
            .withColumn(INGESTED, utc_clock(F.current_timestamp()))
            .withColumn("day", F.to_date(self.event_time))
            .withColumn("bucket", F.pmod(F.xxhash64(self.primary_key[0]), F.lit(BUCKETS)).cast("int")),
            "upsert",
        )
        touched = {(r["day"] and str(r["day"]), r["bucket"]) for r in batch.select("day", "bucket").distinct().collect()}  # bounded by days and buckets
        while touched:
            number, live = self.latest()
            label = uuid.uuid4().hex
            stored = self._rows({part: live[part] for part in touched if part in live}).withColumn("_new", F.lit(0))
            both = stored.unionByName(batch.withColumn("_new", F.lit(1)))
            # Spark cuts each key to its first row before the shuffle too, so many
            # copies of one key do not meet in one task.
            newest = Window.partitionBy(*self.primary_key).orderBy(
                F.col("_new").desc(), F.col(INGESTED).desc(), F.xxhash64(*self.schema.names)
            )
            kept = both.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn", "_new")
            data = f"{self.path}/data/commit={label}"
            (
                kept.hint("rebalance", "day", "bucket").sortWithinPartitions("day", "bucket", *self.primary_key)
                .write.partitionBy("day", "bucket").parquet(data)
            )
            mine = dict.fromkeys(touched, label)
            if self.counted:
                rows = self._rows(mine).groupBy(self.primary_key[0], "day", "bucket").agg(F.count("*").alias("n"))
                rows.coalesce(1).write.partitionBy("day", "bucket").parquet(f"{self.path}/counts/commit={label}")
            parts = [(day, bucket, x) for (day, bucket), x in {**live, **mine}.items()]
            self.spark.createDataFrame(parts, "day string, bucket int, label string").coalesce(1).write.parquet(f"{self.path}/live/{label}")
            if self._publish(number + 1, label):
                return

    def vacuum(self) -> None:
        """Delete commits that hold no part any more. Not while others read or write the table."""
        used = set(self.latest()[1].values())
        for folder in ("data", "counts"):
            for name in child_names(self.spark, f"{self.path}/{folder}"):
                if name.startswith("commit=") and name.removeprefix("commit=") not in used:
                    files, path = self._file(f"{folder}/{name}")
                    files.delete(path, True)


def training_snapshot(table: FeatureTable, start: str, end: str, name: str) -> tuple[int, DataFrame]:
    """Write a time range as the next version of a training set; features and targets stay in one frame."""
    version = max(table_versions(table.spark, table.root, name), default=0) + 1
    path = f"{table.root}/{name}/v{version}"
    table.read(start, end).write.parquet(path)
    return version, table.spark.read.schema(table.schema).parquet(path)

