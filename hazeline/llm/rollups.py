"""Token counts by source, language and tokenizer version, maintained from batches of changes.

A change holds what a document counted before and after: an insert has no `before`, a delete no `after`, a revision both.
Each image is a signed row (-1 or 1), so a batch is a sum by key, and sums of batches add up in any order.

Layout: `<path>/v<n>/rollup` has the sums after commit n, `<path>/v<n>/batches` the ids that commit brought. Both are
written aside and renamed at once, so a batch counts together with its id or not at all.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.session import written
from hazeline.sources.feature_table import child_names, table_versions

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens")
ROLLUP = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
IMAGE = "struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>"


def image(tokenizer: Column | str, n_tokens: Column | str, source: Column | str = "source", lang: Column | str = "lang") -> Column:
    """What a document counts, as one side of a change."""
    named = (F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for c, n in ((source, "source"), (lang, "lang"), (tokenizer, "tokenizer"), (n_tokens, "n_tokens")))
    return F.struct(*named).cast(IMAGE)


def no_image() -> Column:
    return F.lit(None).cast(IMAGE)


def deltas(changes: DataFrame) -> DataFrame:
    """(batch_id, source, lang, tokenizer, n_docs, n_tokens) of rows (batch_id, before, after): signed sums of each batch.

    A side that is missing adds 0, so that a batch without effect still has a row.
    """
    sides = F.array(*(F.struct(F.when(F.col(c).isNotNull(), sign).otherwise(0).alias("sign"), F.col(c).cast(IMAGE).alias("image")) for c, sign in (("before", -1), ("after", 1))))
    rows = changes.select(F.col("batch_id").cast("string").alias("batch_id"), F.explode(sides).alias("side")).select("batch_id", "side.sign", "side.image.*")
    sign, tokens = F.col("sign").cast("long"), F.coalesce("n_tokens", F.lit(0).cast("long"))
    return rows.groupBy("batch_id", *KEYS).agg(F.sum(sign).alias("n_docs"), F.sum(sign * tokens).alias("n_tokens"))


class Rollup:
    """The rollup table in a folder; an empty or missing folder is an empty table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int:
        return max(table_versions(self.spark, *self.path.rsplit("/", 1)), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) after a commit, the last by default; without keys that count nothing."""
        version = self.version() if version is None else version
        rows = self.spark.read.schema(ROLLUP).parquet(f"{self.path}/v{version}/rollup") if version else self.spark.createDataFrame([], ROLLUP)
        return rows.where("n_docs <> 0 or n_tokens <> 0")

    def batches(self, version: int | None = None) -> DataFrame:
        """(batch_id) of every batch committed up to a version."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], "batch_id string")
        return self.spark.read.schema("batch_id string").parquet(*(f"{self.path}/v{n}/batches" for n in range(1, version + 1)))

    def commit(self, changes: DataFrame) -> int:
        """Add the batches of rows (batch_id, before, after) that were not committed before; how many these were.

        The rows of a batch come in one call. A batch id that was committed counts no second time, whatever its rows;
        batches may come in any order, so a sum is below 0 while a delete is there before its insert.
        """
        found = written(deltas(changes), "rollup-deltas")
        if found.where("batch_id is null").head(1):
            raise ValueError("a change without batch id")
        while True:
            version = self.version()
            new = written(found.join(self.batches(version), "batch_id", "left_anti"), "rollup-new")
            ids = new.select("batch_id").distinct()
            n = ids.count()
            if not n:
                return 0
            aside = f"{self.path}/_aside-{uuid.uuid4().hex}"
            ids.write.parquet(f"{aside}/batches")
            both = self.read(version).unionByName(new.drop("batch_id"))
            both.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in SUMS)).write.parquet(f"{aside}/rollup")
            if self._publish(aside, version + 1):
                return n

    def _publish(self, aside: str, version: int) -> bool:
        """Rename to the next version; False, and nothing left aside, if another commit has taken it."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        hadoop = jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(aside), hadoop.Path(f"{self.path}/v{version}")
        fs = source.getFileSystem(conf)
        source, target = fs.makeQualified(source), fs.makeQualified(target)
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        try:
            hadoop.FileContext.getFileContext(source.toUri(), conf).rename(source, target, options)
        except Exception:
            if f"v{version}" not in child_names(self.spark, self.path):
                raise
            fs.delete(source, True)
            return False
        return True
