"""A table whose batches each rewrite only the partitions that they touch, with a ledger of batches beside it.

    path/data/<batch>/<column>=<value>/...    what a batch wrote: whole new versions of the partitions that it touched
    path/ledger/<number>-<batch>.json         that it is in, and which partitions it wrote

A batch is in when its ledger file is, which appears at once. A run that fails before leaves files that nobody reads; the same batch
may then be sent again. A batch that is in changes nothing when it is sent again. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

Merge = Callable[[DataFrame, "DataFrame | None"], DataFrame]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partitions: list[str]):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), partitions

    def _ledger(self) -> DataFrame | None:
        if not files.exists(self.spark, f"{self.path}/ledger"):
            return None
        return self.spark.read.schema("number long, batch string, rows string, parts array<string>").json(f"{self.path}/ledger")

    def batches(self) -> list[str]:
        """The batches that are in, in order."""
        ledger = self._ledger()
        return [] if ledger is None else [r["batch"] for r in ledger.select("number", "batch").orderBy("number").collect()]

    def _versions(self) -> dict[str, str]:
        """The folder of each partition's newest version: a row for each partition."""
        ledger = self._ledger()
        if ledger is None:
            return {}
        parts = ledger.select("number", "batch", F.explode("parts").alias("part"))
        newest = parts.groupBy("part").agg(F.max_by("batch", "number").alias("batch"))
        return {r["part"]: f"{self.path}/data/{quote(r['batch'], safe='')}/{r['part']}" for r in newest.collect()}

    def _read(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        ledger = self._ledger()
        schema = json.loads(ledger.orderBy(F.desc("number")).first()["rows"])
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(schema)).parquet(*sorted(folders))

    def read(self) -> DataFrame | None:
        """The whole table as it is now; None before the first batch."""
        return self._read(list(self._versions().values()))

    def apply(self, batch: str, new: DataFrame, merge: Merge) -> bool:
        """Merges new rows, which have the partition columns, with those of the partitions that they touch. merge(new, old or None)
        gives these partitions' rows. Returns whether the batch was new."""
        done = self.batches()
        if batch in done:
            return False
        touched = [_part(self.partitions, r) for r in new.select(*self.partitions).distinct().collect()]
        have = self._versions()
        out = merge(new, self._read([have[p] for p in touched if p in have]))
        folder = f"{self.path}/data/{quote(batch, safe='')}"
        shown = out.select("*", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in self.partitions])
        shown.hint("rebalance", *[f"_{c}" for c in self.partitions]).write.mode("overwrite").partitionBy(*[f"_{c}" for c in self.partitions]).parquet(folder)
        written = {name.rsplit("/", 1)[0] for name in files.files(self.spark, folder)}
        entry = {"number": len(done), "batch": batch, "rows": out.schema.json(), "parts": sorted(written)}
        files.write_text(self.spark, f"{self.path}/ledger/{len(done):09d}-{quote(batch, safe='')}.json", json.dumps(entry) + "\n")
        return True

    def vacuum(self) -> int:
        """Removes versions that no reader of now would read; returns how many folders went."""
        kept, gone = set(self._versions().values()), 0
        for name in {f.rsplit("/", 1)[0] for f in files.files(self.spark, f"{self.path}/data")}:
            if f"{self.path}/data/{name}" not in kept:
                files.remove(self.spark, f"{self.path}/data/{name}")
                gone += 1
        return gone


def _part(columns: list[str], row) -> str:
    """The folder of a partition, as Spark names it."""
    escaped = lambda v: "__HIVE_DEFAULT_PARTITION__" if v in (None, "") else "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{[]^\x7f' or ord(c) < 32 else c for c in str(v))
    return "/".join(f"_{c}={escaped(row[c])}" for c in columns)
