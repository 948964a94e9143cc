"""Tables kept by micro-batches: immutable runs of files and a manifest, swapped last, that names the live ones.

``write(df, b)`` puts the rows of batch ``b`` into a new run, a folder of its
own, partitioned by the bucket of the user.  Nothing is read from a run until
a manifest names it: the manifest of the batch is put in place last, as one
new small file, and readers take the newest manifest and trust it alone.  A
batch that stops before that leaves files that nobody reads.  A batch written
again (a replay) starts from the manifest before it and puts a new one of the
same batch in place.

Runs have levels, by bucket.  A batch is a run of level 0; a bucket that has
``fan`` runs of one level gets them folded into one run of the next level (the
last row of each user).  So a fold rewrites the buckets that are due and no
other, a row is rewritten once for each level, and a reader meets fewer than
``fan`` runs of a level in each bucket.

Manifests older than ``grace`` seconds go (never the two newest batches'), and
with them the files that no manifest left names, once these are as old: a
reader has that long to finish.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.sources.files import Files
from reelrank.sources.tables import user_bucket

BUCKETS = 64
FAN = 8
GRACE_S = 3600.0


@dataclass(frozen=True)
class Run:
    """A folder of files; ``buckets`` are those still live in it."""

    name: str
    level: int
    buckets: tuple[int, ...]


@dataclass
class BatchTable:
    """Rows by micro-batch below ``root``, with the number of their batch; every batch's rows count.

    One bucket; folding only joins small runs.
    """

    spark: SparkSession
    root: str
    buckets: int = 1
    fan: int = FAN
    grace: float = GRACE_S

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.files = Files(self.spark)

    # ------------------------------------------------------------ manifests
    def _manifests(self) -> list[str]:
        return sorted(n for n in self.files.list(f"{self.root}/manifests") if n.endswith(".json") and not n.startswith("."))

    @staticmethod
    def _batch_of(name: str) -> int:
        return int(name.split("-")[0])

    def version(self, before: int | None = None) -> str | None:
        """The newest manifest (of the batches below ``before``)."""
        names = [n for n in self._manifests() if before is None or self._batch_of(n) < before]
        return names[-1] if names else None

    def live(self, before: int | None = None) -> list[Run]:
        """The live runs, as the newest manifest names them."""
        name = self.version(before)
        if name is None:
            return []
        found = json.loads(self.files.read(f"{self.root}/manifests/{name}"))
        return [Run(r["name"], r["level"], tuple(r["buckets"])) for r in found["runs"]]

    def _swap(self, batch_id: int, runs: list[Run]) -> None:
        """The manifest of a batch, put in place as a whole; later attempts at a batch come after the earlier ones."""
        tries = sum(self._batch_of(n) == batch_id for n in self._manifests())
        text = json.dumps({"batch": batch_id, "at": time.time(), "runs": [
            {"name": r.name, "level": r.level, "buckets": r.buckets} for r in runs if r.buckets]})
        self.files.put(f"{self.root}/manifests/{batch_id:012d}-{tries:04d}.json", text)

    # -------------------------------------------------------------- reading
    def _read(self, runs: list[Run], buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of the live buckets of ``runs``; only folders of ``buckets`` are opened."""
        wanted = None if buckets is None else set(buckets)
        asked = [(r.name, sorted(r.buckets if wanted is None else wanted & set(r.buckets))) for r in runs]
        asked = [(name, bs) for name, bs in asked if bs]
        if not asked:
            return None
        by_buckets = defaultdict(list)
        for name, bs in asked:
            by_buckets[tuple(bs)].append(name)
        places = [F.col("run").isin(names) & F.col("bucket").isin(list(bs)) for bs, names in by_buckets.items()]
        data = f"{self.root}/data"
        return (self.spark.read.option("basePath", data).parquet(*[f"{data}/run={name}" for name, _ in asked])
                .where(reduce(Column.__or__, places)).drop("run", "bucket"))

    def rows(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """All live rows with their ``batch_id`` (of ``buckets``, as of the batches below ``before``); None if there are none."""
        return self._read(self.live(before), buckets)

    # -------------------------------------------------------------- writing
    def _bucket(self) -> Column:
        return F.lit(0)

    def _last(self, rows: DataFrame) -> DataFrame:
        return rows

    def _put(self, rows: DataFrame, name: str, level: int) -> Run:
        path = f"{self.root}/data/run={name}"
        rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
        found = [int(n.removeprefix("bucket=")) for n in self.files.list(path) if n.startswith("bucket=")]
        return Run(name, level, tuple(sorted(found)))

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Write (or write again) the rows of a batch: its run, the folds that are due, then the manifest."""
        runs = self.live(batch_id)
        rows = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        runs.append(self._put(rows, f"b{batch_id}-{uuid.uuid4().hex}", 0))
        runs, folded = self._folded(runs, batch_id)
        self._swap(batch_id, runs)
        if folded:
            self.drop_superseded()

    def _folded(self, runs: list[Run], batch_id: int) -> tuple[list[Run], bool]:
        level, folded = 0, False
        while any(r.level >= level for r in runs):
            count: dict[int, int] = defaultdict(int)
            for r in runs:
                for b in r.buckets if r.level == level else ():
                    count[b] += 1
            due = {b for b, n in count.items() if n >= self.fan}
            if due:
                # a bucket's runs of one level are folded together, other buckets keep their files
                rows = self._last(self._read([r for r in runs if r.level == level], sorted(due)))
                new = self._put(rows, f"f{batch_id}-{level + 1}-{uuid.uuid4().hex}", level + 1)
                runs = [Run(r.name, r.level, tuple(b for b in r.buckets if b not in due)) if r.level == level else r
                        for r in runs] + [new]
                runs, folded = [r for r in runs if r.buckets], True
            level += 1
        return runs, folded

    def drop_superseded(self) -> None:
        """Delete old manifests, and the files that no manifest left names and that are as old."""
        now = time.time()
        names = self._manifests()
        newest = sorted({self._batch_of(n) for n in names})[-2:]
        times = self.files.list(f"{self.root}/manifests")
        old = [n for n in names if self._batch_of(n) not in newest and times[n] / 1000 < now - self.grace]
        for n in old:
            self.files.delete(f"{self.root}/manifests/{n}")
        named: dict[str, set[int]] = defaultdict(set)
        for n in set(names) - set(old):
            for r in json.loads(self.files.read(f"{self.root}/manifests/{n}"))["runs"]:
                named[r["name"]] |= set(r["buckets"])
        for folder, changed in self.files.list(f"{self.root}/data").items():
            name = folder.removeprefix("run=")
            if changed / 1000 >= now - self.grace:
                continue
            if name not in named:
                self.files.delete(f"{self.root}/data/{folder}")
                continue
            for part in self.files.list(f"{self.root}/data/{folder}"):
                if part.startswith("bucket=") and int(part.removeprefix("bucket=")) not in named[name]:
                    self.files.delete(f"{self.root}/data/{folder}/{part}")


@dataclass
class UserLog(BatchTable):
    """One row ``(uid, value)`` per user, kept by micro-batches: the last batch that has a user wins."""

    value: str = "recs"
    buckets: int = BUCKETS

    def _bucket(self) -> Column:
        return F.coalesce(user_bucket("uid", self.buckets), F.lit(0))

    def _last(self, rows: DataFrame) -> DataFrame:
        """``max_by`` is combined before the shuffle."""
        return rows.groupBy("uid").agg(F.max_by(self.value, "batch_id").alias(self.value), F.max("batch_id").alias("batch_id"))

    def write(self, df: DataFrame, batch_id: int) -> None:
        super().write(df.select("uid", self.value), batch_id)

    def latest(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """(uid, value): the last row of each user (of ``buckets``); None if nothing is written."""
        rows = self.rows(before, buckets)
        return None if rows is None else self._last(rows).select("uid", self.value)
