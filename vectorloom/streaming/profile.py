"""A profile that grows with a stream: every micro-batch adds its statistics and its labels.

A batch writes what it adds, under its own number, and then a mark. Readers see marked batches only, so a batch that
failed half-way or is replayed after a restart counts once: it writes the same folder again. Now and then the
batches so far are merged into one base, so that reading stays cheap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vectorloom.operators.profile import (
    STATS_SCHEMA,
    LabelTable,
    Profile,
    column_stats,
    empty_labels,
    label_counts,
    make_profile,
    merge_stats,
    number_labels,
)
from vectorloom.plans.spec import FeatureSpec, Transform, load_spec
from vectorloom.session import delete_path

# Batches that are merged into a base at a time.
MERGE_EVERY = 20
_PARTS, _BASE, _MARKS = "parts", "base", "marks"


class ProfileStore:
    """The parts of a growing profile in a shared folder."""

    def __init__(self, spark: SparkSession, path: str, spec: FeatureSpec, position: list[str], merge_every: int = MERGE_EVERY) -> None:
        self.spark, self.path, self.spec, self.position, self.merge_every = spark, path, spec, position, merge_every
        found = self._read("spec")
        if found is None:
            spark.createDataFrame([(spec.to_text(),)], "spec string").coalesce(1).write.parquet(f"{path}/spec")
        elif load_spec(found.first()["spec"]) != spec:
            raise ValueError(f"{path} holds a profile of another spec")
        self.nominal = [c for c in spec.nominal if c.transform is not Transform.SKIP]

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _marks(self) -> list[tuple[str, int]]:
        """(kind, batch) of what is complete: the newest base and the batches after it."""
        found = self._read(_MARKS)
        marks = [(r["kind"], r["batch"]) for r in found.select("kind", "batch").distinct().collect()] if found else []
        base = max((b for kind, b in marks if kind == _BASE), default=None)
        parts = sorted(b for kind, b in marks if kind == _PARTS and (base is None or b > base))
        return ([] if base is None else [(_BASE, base)]) + [(_PARTS, b) for b in parts]

    def _write(self, kind: str, batch: int, stats: DataFrame, labels: DataFrame | None) -> None:
        place = f"{self.path}/{kind}/{batch}"
        stats.coalesce(1).write.mode("overwrite").parquet(f"{place}/stats")
        if labels is not None:
            labels.write.mode("overwrite").parquet(f"{place}/labels")
        mark = self.spark.createDataFrame([(kind, batch)], "kind string, batch bigint")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{_MARKS}/at={kind}-{batch}")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Count the typed rows of a batch; a batch that is complete already changes nothing."""
        marks = self._marks()
        if any(batch <= b if kind == _BASE else batch == b for kind, b in marks):
            return
        labels = None
        if self.nominal:
            labels = label_counts(rows, self.nominal, self.position).withColumn("batch", F.lit(batch).cast("bigint"))
        self._write(_PARTS, batch, column_stats(rows, self.spec), labels)
        if len(marks) + 1 > self.merge_every:
            self.merge()

    def merge(self) -> None:
        """Make one base of all complete batches, and delete what it replaces."""
        marks = self._marks()
        if len(marks) < 2:
            return
        self._write(_BASE, marks[-1][1], self._stats(marks), self._labels(marks) if self.nominal else None)
        for kind, b in marks:
            delete_path(self.spark, f"{self.path}/{_MARKS}/at={kind}-{b}")
            delete_path(self.spark, f"{self.path}/{kind}/{b}")

    def _stats(self, marks: list[tuple[str, int]]) -> DataFrame:
        return merge_stats([self.spark.read.schema(STATS_SCHEMA).parquet(f"{self.path}/{kind}/{b}/stats") for kind, b in marks])

    def _labels(self, marks: list[tuple[str, int]]) -> DataFrame:
        """Count of each label, the batch that brought it and its first position there."""
        parts = [self.spark.read.parquet(f"{self.path}/{kind}/{b}/labels") for kind, b in marks]
        # one row per label and batch: text reaches the aggregate only as a key
        first = F.min(F.struct("batch", "first_at")).alias("first")
        counts = reduce(DataFrame.unionByName, parts).groupBy("column_name", "label").agg(F.sum("n").alias("n"), first)
        return counts.select("column_name", "label", "n", "first.first_at", "first.batch")

    def profile(self) -> Profile:
        """The profile of all complete batches.

        Labels are numbered by the batch that brought them, then by position in it: ids never change as more batches come.
        """
        marks = self._marks()
        if not marks:
            raise ValueError(f"{self.path} holds no complete batch")

        def labels() -> LabelTable:
            if not self.nominal:
                return empty_labels(self.spark)
            return number_labels(self._labels(marks).withColumn("first_at", F.struct("batch", "first_at")).drop("batch"))

        return make_profile(self.spark, self.spec, self._stats(marks).orderBy("ordinal").collect(), labels)


def profile_stream(rows: DataFrame, store: ProfileStore, checkpoint: str, **trigger) -> StreamingQuery:
    """Run a stream of typed rows, with the position columns, into ``store``; ``trigger`` as for a stream writer."""

    def count(batch: DataFrame, number: int) -> None:
        store.add(batch, number)

    writer = rows.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start() if trigger else writer.start()
