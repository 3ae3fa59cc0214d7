"""Results kept as one folder per query and batch, so that a replayed batch replaces itself.

Batch ids begin anew with a new checkpoint. The id of the streaming query, which its checkpoint
holds, keeps its results apart from those of others before it; a small pointer names the query
that wrote last.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_POINTER = "_current"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


@dataclass
class Results:
    """Where a streaming query, known by its checkpoint, keeps results under ``out``."""

    spark: SparkSession
    out: str
    checkpoint: str

    @cached_property
    def query_id(self) -> str:
        """The query's id, as its checkpoint has it from the start on."""
        return json.loads(self.spark.read.text(f"{self.checkpoint}/metadata").first()[0])["id"]

    def view(self, name: str) -> View:
        return View(self.spark, f"{self.out}/views/{name}", self.query_id)

    def day_view(self, name: str) -> DayView:
        return DayView(self.spark, f"{self.out}/views/{name}", self.query_id)


@dataclass
class View:
    """The results of one query under ``base``, a folder for each of its batches."""

    spark: SparkSession
    base: str
    query_id: str

    @property
    def _home(self) -> str:
        return f"{self.base}/query={self.query_id}"

    def batches(self) -> dict[int, bool]:
        """The batches there are, and whether each was written to its end."""
        path, files = _file_system(self.spark, self._home)
        if not files.exists(path):
            return {}
        found = {}
        for status in files.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("batch="):
                done = _file_system(self.spark, f"{self._home}/{name}/_SUCCESS")[0]
                found[int(name.removeprefix("batch="))] = files.exists(done)
        return found

    def write(self, rows: DataFrame, batch_id: int, keep: int = 5) -> None:
        """Write a batch's result, and drop those more than ``keep`` batches older.

        A view is replaced as a whole, so old ones are of no use but to a reader that has just
        begun on one.
        """
        rows.write.mode("overwrite").parquet(f"{self._home}/batch={batch_id}")
        older = sorted(b for b in self.batches() if b < batch_id)
        for old in older[: -keep or None]:
            path, files = _file_system(self.spark, f"{self._home}/batch={old}")
            files.delete(path, True)
        self._point()

    def _point(self) -> None:
        """Let readers find the results of this query."""
        point_to(self.spark, self.base, self.query_id)

    def newest_batch(self, before: int | None = None) -> int | None:
        """The newest finished batch, of those before ``before``."""
        finished = (
            b for b, done in self.batches().items() if done and (before is None or b < before)
        )
        return max(finished, default=None)

    def newest(self, before: int | None = None, schema: StructType | None = None) -> DataFrame | None:
        """The newest finished result, of the batches before ``before``.

        A given ``schema`` spares the job that reads it from the files.
        """
        newest = self.newest_batch(before)
        if newest is None:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(f"{self._home}/batch={newest}")


@dataclass
class DayView(View):
    """Rows of many days, of which a batch writes only the days that it changes.

    ``data/batch=N/day=D`` holds a day as it was after batch ``N``, and ``manifest/N`` tells for
    each day which batch wrote it last. A batch is there when its manifest is; a replayed one writes
    the same folder and manifest again, from the manifest before it.
    """

    DAY = "_day"

    @property
    def _manifests(self) -> str:
        return f"{self._home}/manifest"

    def batches(self) -> dict[int, bool]:
        """The batches that have a manifest."""
        names = child_names(self.spark, self._manifests)
        return {int(n): True for n in names if n.isdigit()}

    def manifest(self, before: int | None = None) -> dict[str, int]:
        """The batch that holds each day, by the newest manifest of the batches before ``before``."""
        known = [b for b in self.batches() if before is None or b < before]
        if not known:
            return {}
        return json.loads(read_text(self.spark, f"{self._manifests}/{max(known)}"))

    def _read(self, days: dict[str, int], schema: StructType | None) -> DataFrame | None:
        if not days:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*(f"{self._home}/data/batch={b}/{self.DAY}={d}" for d, b in days.items()))

    def newest(self, before: int | None = None, schema: StructType | None = None) -> DataFrame | None:
        return self._read(self.manifest(before), schema)

    def merge(self, changed: DataFrame, keys: Sequence[str], batch_id: int, keep: int = 5) -> None:
        """Write the days of the ``changed`` rows, whose first key is a time, with all their rows.

        Other rows of these days come from the batch before. Days that are not touched are neither
        read nor written, so a batch costs by what it changes, not by how long the shop is there.
        """
        day = F.to_date(keys[0]).cast("string")

        def replaced(previous: DataFrame) -> DataFrame:
            same = [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
            kept = previous.alias("p").join(changed.alias("c"), same, "left_anti")
            return changed.unionByName(kept)

        self._rewrite(changed, day, replaced, batch_id, keep)

    def fold(
        self,
        added: DataFrame,
        keys: Sequence[str],
        merge: Callable[[DataFrame], DataFrame],
        batch_id: int,
        buckets: int = 16,
        keep: int = 5,
    ) -> list[str]:
        """Add totals to those kept, in buckets by ``keys`` in place of days; gives the buckets.

        ``merge`` makes one row of those with the same keys. The number of buckets is that of the
        first batch for good.
        """
        before = next(iter(self.manifest(batch_id)), None)
        buckets = int(before.split("-")[0]) if before else buckets
        bucket = F.concat(F.lit(f"{buckets}-"), F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        return self._rewrite(
            added, bucket, lambda previous: merge(added.unionByName(previous)), batch_id, keep
        )

    def fold_days(
        self,
        added: DataFrame,
        merge: Callable[[DataFrame], DataFrame],
        keys: Sequence[str],
        batch_id: int,
        keep: int = 5,
    ) -> list[str]:
        """Add totals to those kept of the same days; gives the days.

        The first of ``keys`` is a time, and ``merge`` makes one row of those with the same keys.
        """
        day = F.to_date(keys[0]).cast("string")
        return self._rewrite(
            added, day, lambda previous: merge(added.unionByName(previous)), batch_id, keep
        )

    def of_days(self, days: Sequence[str], batch_id: int, schema: StructType) -> DataFrame | None:
        """All rows of the named days or buckets after batch ``batch_id``."""
        named = self.manifest(batch_id + 1)
        return self._read({d: named[d] for d in days}, schema)

    def _rewrite(
        self,
        rows: DataFrame,
        day: Column,
        with_previous: Callable[[DataFrame], DataFrame],
        batch_id: int,
        keep: int,
    ) -> list[str]:
        days = self.manifest(batch_id)
        touched = sorted(r[0] for r in rows.select(day).distinct().collect())
        previous = self._read({d: days[d] for d in touched if d in days}, rows.schema)
        if previous is not None:
            rows = with_previous(previous)
        # One file a day; a day's windows are few, and so is a bucket's share of the products.
        rows.withColumn(self.DAY, day).repartition(self.DAY).write.mode("overwrite").partitionBy(
            self.DAY
        ).parquet(f"{self._home}/data/batch={batch_id}")
        now = days | {d: batch_id for d in touched}
        write_text(self.spark, f"{self._manifests}/{batch_id}", json.dumps(now))
        self._drop_old(batch_id, keep)
        self._point()
        return touched

    def _drop_old(self, batch_id: int, keep: int) -> None:
        """Delete manifests more than ``keep`` batches older, and days that only these name."""
        older = sorted(b for b in self.batches() if b < batch_id)
        dropped = older[: -keep or None]
        if not dropped:
            return
        kept = [b for b in older if b not in dropped] + [batch_id]
        named = {(d, b) for k in kept for d, b in self.manifest(k + 1).items()}
        for old in dropped:
            for d, b in json.loads(read_text(self.spark, f"{self._manifests}/{old}")).items():
                if (d, b) not in named:
                    path, files = _file_system(self.spark, f"{self._home}/data/batch={b}/{self.DAY}={d}")
                    files.delete(path, True)
            path, files = _file_system(self.spark, f"{self._manifests}/{old}")
            files.delete(path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, which is there whole or not at all where renaming is atomic."""
    target, files = _file_system(spark, path)
    part, _ = _file_system(spark, f"{path.rpartition('/')[0]}/.{target.getName()}.part")
    stream = files.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files.delete(target, False)
    files.rename(part, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    path, files = _file_system(spark, path)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    path, files = _file_system(spark, path)
    if not files.exists(path):
        return []
    return [status.getPath().getName() for status in files.listStatus(path)]


def delete_path(spark: SparkSession, path: str) -> None:
    path, files = _file_system(spark, path)
    files.delete(path, True)


def point_to(spark: SparkSession, base: str, query_id: str) -> None:
    """Let the pointer under ``base`` name the query."""
    if current_query(spark, base) != query_id:
        write_text(spark, f"{base}/{_POINTER}", query_id)


def current_query(spark: SparkSession, base: str) -> str | None:
    """The id of the query that the pointer under ``base`` names."""
    return read_text(spark, f"{base}/{_POINTER}")


def latest_view(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The latest result of a named stream written by ``run_streams`` under ``out``."""
    base = f"{out}/views/{name}"
    query_id = current_query(spark, base)
    for kind in (View, DayView):
        rows = kind(spark, base, query_id).newest() if query_id else None
        if rows is not None:
            return rows
    raise LookupError(f"{name} has no result under {out} yet")
