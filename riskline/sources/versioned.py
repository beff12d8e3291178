"""Tables that micro-batches append to, merged into a current table now and then.

Layout below the table's folder::

    <partition>/batch_id=<n>/    what micro-batch n wrote (a replay overwrites it)
    _base/<v>/                   the merge of all batches up to some id
    _manifest/<v>                one line of JSON: base, covered batch id, key, order

A reader takes the newest manifest: its base, and the batches with a larger id.  ``compact`` writes a new base next to
the old one, then the manifest by renaming a finished file to a name that must not exist yet, so readers see either
the old state or the new one, and of two writers one fails.  Work that broke off before the rename is invisible and removed
by the next ``clean``.  A replayed micro-batch that is covered already writes its own folder, which no reader takes, so
nothing doubles.  ``clean`` removes what neither the newest nor the one before it needs.

With a key, the merge keeps one row a key, the last by ``order`` (an upsert log becomes its current table); without,
all rows.  Names that begin with an underscore are hidden from Spark's own listing of the folder.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.sources.tables import path_exists


@dataclass(frozen=True)
class Manifest:
    version: int
    base: str | None
    covered: int  # largest batch id in the base, -1 for none


@dataclass
class VersionedTable:
    spark: SparkSession
    path: str
    partitions: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    file_rows: int = 1_000_000

    # -- files --------------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _list(self, folder: str) -> list[str]:
        fs, p = self._fs(os.path.join(self.path, folder))
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _read_text(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def manifests(self) -> list[Manifest]:
        """Published states, the newest last."""
        names = [n for n in self._list("_manifest") if n.isdigit()]
        return [Manifest(**json.loads(self._read_text(os.path.join(self.path, "_manifest", n)))) for n in names]

    def manifest(self) -> Manifest:
        names = [n for n in self._list("_manifest") if n.isdigit()]
        if not names:
            return Manifest(0, None, -1)
        return Manifest(**json.loads(self._read_text(os.path.join(self.path, "_manifest", names[-1]))))

    def _publish(self, state: Manifest) -> None:
        folder = os.path.join(self.path, "_manifest")
        draft = os.path.join(folder, f".{uuid.uuid4().hex}")
        fs, p = self._fs(draft)
        out = fs.create(p)
        out.write(bytearray(json.dumps(state.__dict__).encode("utf-8")))
        out.close()
        _, name = self._fs(os.path.join(folder, f"{state.version:012d}"))
        if fs.exists(name) or not fs.rename(p, name):
            fs.delete(p, False)
            raise RuntimeError(f"another writer has published version {state.version} of {self.path}")

    # -- rows ---------------------------------------------------------------------------------------------------

    def write(self, df: DataFrame, batch_id: int) -> None:
        """The rows of one micro-batch; a replay writes the same folders again."""
        (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partitions, "batch_id").parquet(self.path))

    def _batches(self, after: int, upto: int | None) -> DataFrame | None:
        if not path_exists(self.spark, self.path) or not [n for n in self._list("") if n[0] not in "_."]:
            return None
        rows = self.spark.read.parquet(self.path).where(F.col("batch_id") > after)
        return rows if upto is None else rows.where(F.col("batch_id") <= upto)

    def _last(self, rows: DataFrame) -> DataFrame:
        if not self.key:
            return rows
        content = F.struct(*[c for c in rows.columns if c not in self.key])
        latest = F.max_by(content, F.struct(*(self.order or ("batch_id",)), "batch_id"))
        return rows.groupBy(*self.key).agg(latest.alias("_row")).select(*self.key, "_row.*").select(rows.columns)

    def read(self, before: int | None = None) -> DataFrame | None:
        """All rows (with a key: the last of each), those of batches below ``before`` if given; None before the first batch.

        ``before`` must not be below what a merge has covered already.
        """
        state = self.manifest()
        if before is not None and before <= state.covered:
            # a replay of a covered batch: the base holds its rows already, told apart by their batch id
            base = self.spark.read.parquet(os.path.join(self.path, state.base)).where(F.col("batch_id") < before)
            return self._last(base)
        fresh = self._batches(state.covered, None if before is None else before - 1)
        if state.base is None:
            return None if fresh is None else self._last(fresh)
        base = self.spark.read.parquet(os.path.join(self.path, state.base))
        return self._last(base if fresh is None else base.unionByName(fresh.select(base.columns)))

    # -- maintenance --------------------------------------------------------------------------------------------

    def compact(self, upto: int) -> Manifest:
        """Merge all finished batches up to ``upto`` into a new base and publish it."""
        state = self.manifest()
        fresh = self._batches(state.covered, upto)
        if fresh is None or upto <= state.covered or fresh.isEmpty():
            return state
        if state.base is not None:
            base = self.spark.read.parquet(os.path.join(self.path, state.base))
            fresh = base.unionByName(fresh.select(base.columns))
        merged = self._last(fresh)
        folder = os.path.join("_base", uuid.uuid4().hex)
        if self.partitions:
            # as many files as tasks for every value; a value with many rows is split by their number
            writer = merged.repartition(*self.partitions).write.partitionBy(*self.partitions)
        else:
            writer = merged.repartition(max(1, -(-merged.count() // self.file_rows))).write
        writer.option("maxRecordsPerFile", self.file_rows).mode("overwrite").parquet(os.path.join(self.path, folder))
        made = Manifest(state.version + 1, folder, upto)
        self._publish(made)
        return made

    def clean(self) -> None:
        """Remove batches and bases that neither the newest state nor the one before it needs."""
        states = self.manifests()
        if not states:
            return
        needed = {s.base for s in states[-2:] if s.base}
        covered = states[-2].covered if len(states) > 1 else -1
        fs, _ = self._fs(self.path)
        for name in self._list("_base"):
            if os.path.join("_base", name) not in needed:
                fs.delete(self._fs(os.path.join(self.path, "_base", name))[1], True)
        for s in states[:-2]:
            fs.delete(self._fs(os.path.join(self.path, "_manifest", f"{s.version:012d}"))[1], False)
        pattern = "/".join([self.path, *["*"] * len(self.partitions), "batch_id=*"])
        for found in fs.globStatus(self._fs(pattern)[1]) or []:
            if int(found.getPath().getName().split("=")[1]) <= covered:
                fs.delete(found.getPath(), True)

    def files(self) -> int:
        """Data files below the folder, those of no reader included."""
        fs, p = self._fs(self.path)
        total, found = 0, fs.listFiles(p, True)
        while found.hasNext():
            total += found.next().getPath().getName().endswith(".parquet")
        return total
