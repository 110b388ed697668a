"""Token counts as a rollup kept up to date by deltas.

A batch is a table of changes, one row each: `op` is insert, delete or revise; source, lang,
tokenizer and n_tokens say what now holds, and old_source, old_lang, old_tokenizer and old_tokens
what held before (for delete and revise). A change becomes signed rows: an insert +1 document and
+n tokens, a delete -1 and -n, a revision both. They are summed by source, language and tokenizer
version before and after the shuffle, so a source with a third of all rows is a few rows by then,
and the sums are committed as the delta of the batch.

A commit is idempotent. The delta of a batch has its own folder in the store, which counts from
the moment its success marker is there; a batch that is applied again is left alone if it has
been committed, and replaces what a failed attempt left if not. The totals are the sum of all
deltas, so batches can come in any order; `compact` folds them into one delta that remembers
which batches it holds.

Null source, language or tokenizer are a group of their own. A null count is 0. A null or unknown
op changes nothing. Repeated rows of a batch are changes of their own. A batch without rows is
committed as such. Groups whose documents and tokens are both back at 0 are not reported.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
#: Names of batches.
_BATCH = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows (source, lang, tokenizer, docs, tokens) of a batch of changes."""
    now = F.struct(
        *KEYS, F.lit(1).alias("docs"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("tokens")
    )
    was = F.struct(
        *[F.col(f"old_{k}").alias(k) for k in KEYS],
        F.lit(-1).alias("docs"),
        (-F.coalesce("old_tokens", F.lit(0))).cast("long").alias("tokens"),
    )
    rows = (
        F.when(F.col("op") == "insert", F.array(now))
        .when(F.col("op") == "delete", F.array(was))
        .when(F.col("op") == "revise", F.array(was, now))
    )
    return changes.select(F.inline(rows))


class TokenRollup:
    """Totals in a folder of the shared file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        at = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _has(self, path: str) -> bool:
        return self._fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path))

    def _folders(self, kind: str) -> list[str]:
        path = f"{self.path}/{kind}"
        if not self._has(path):
            return []
        found = self._fs.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(path))
        return sorted(
            f"{path}/{x.getPath().getName()}"
            for x in found
            if self._has(f"{path}/{x.getPath().getName()}/_SUCCESS")
        )

    def _snapshot(self) -> str | None:
        """The newest compacted delta; its name begins with its number."""
        return max(self._folders("snapshot"), default=None)

    def _held(self, newest: str | None) -> set[str]:
        """Batches in a snapshot: few names, one for each commit."""
        if newest is None:
            return set()
        return {r[0] for r in self.spark.read.parquet(f"{newest}-batches").collect()}

    def committed(self, batch: str) -> bool:
        return self._has(f"{self.path}/delta/{batch}/_SUCCESS") or batch in self._held(
            self._snapshot()
        )

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch; False if it had been committed before, and then nothing changes.

        The name is that of a folder: letters, digits, `.`, `_`, `-`, a letter or digit first.
        """
        if not _BATCH.fullmatch(batch):
            raise ValueError(f"not a name of a batch: {batch!r}")
        if self.committed(batch):
            return False
        delta = (
            signed(changes)
            .groupBy(*KEYS)
            .agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        )
        delta.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/delta/{batch}")
        return True

    def _open(self, held: set[str]) -> list[str]:
        return [f for f in self._folders("delta") if f.rpartition("/")[2] not in held]

    def _summed(self, paths: list[str]) -> DataFrame:
        deltas = (
            self.spark.read.schema(_DELTA).parquet(*paths)
            if paths
            else self.spark.createDataFrame([], _DELTA)
        )
        return (
            deltas.groupBy(*KEYS)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs <> 0 OR n_tokens <> 0")
        )

    def totals(self) -> DataFrame:
        """Sums over the newest snapshot, as it is now, and the deltas it doesn't hold."""
        newest = self._snapshot()
        return self._summed([*self._open(self._held(newest)), *([newest] if newest else [])])

    def compact(self) -> None:
        """Fold the deltas into a snapshot. Readers see it only when all of it is there.

        It sums exactly the folders that it lists once; a batch that commits meanwhile stays a
        delta. Of two compactions at a time one wins, and either is whole.
        """
        newest = self._snapshot()
        number = int(newest.rpartition("/")[2].split("-")[0]) + 1 if newest else 0
        held = self._held(newest)
        opened = self._open(held)
        batches = sorted(held | {f.rpartition("/")[2] for f in opened})
        name = f"{self.path}/snapshot/{number:08d}-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(
            1
        ).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
            f"{name}-batches"
        )
        self._summed([*opened, *([newest] if newest else [])]).coalesce(1).write.parquet(name)
