"""The keys of an index in buckets of their hash, so that a batch reads the buckets of its own keys only.

Each batch adds its new keys as one folder with a file for each bucket. After `most` such folders they are
merged into one, so the files that a batch reads have a fixed bound, however many batches came before.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.sources.warc import storage

#: Number of the folder with the keys that were there before the first batch.
FIRST = -1


@dataclass(frozen=True)
class KeyStore:
    """Keys at path, in folders `add=n` of batch n and `all=n` of all batches up to n. A folder counts once it is
    whole. Batches are numbered upwards; one that comes again sees what it saw before, and writes the same."""

    path: str
    key: str = "doc_id"
    buckets: int = 64
    most: int = 8

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _folders(self) -> dict[str, list[int]]:
        """Numbers of the whole folders of each kind."""
        store, root = storage(self.path)
        found: dict[str, list[int]] = {"add": [], "all": []}
        for entry in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if (m := re.fullmatch(r"(add|all)=(-?\d+)", entry.base_name)) and store.get_file_info(f"{entry.path}/_SUCCESS").is_file:
                found[m[1]].append(int(m[2]))
        return found

    def _live(self, before: int) -> list[str]:
        """The folders that hold the keys of all batches before this one, each key's in one."""
        found = self._folders()
        base = max((n for n in found["all"] if n < before), default=None)
        added = sorted(n for n in found["add"] if n < before and (base is None or n > base))
        return ([f"all={base}"] if base is not None else []) + [f"add={n}" for n in added]

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        rows = [spark.read.schema(f"`{self.key}` string, bucket int").parquet(f"{self.path}/{f}") for f in folders]
        out = rows[0]
        for more in rows[1:]:
            out = out.unionByName(more)
        return out

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.select(self.key, self.bucket().alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/{folder}")

    def start(self, index: DataFrame) -> None:
        """Take over the keys of an index that is there already, once."""
        if FIRST not in (found := self._folders())["all"] and not found["add"]:
            self._write(index.select(self.key).distinct(), f"all={FIRST}")

    def known(self, batch: DataFrame, number: int) -> DataFrame:
        """The keys of batches before this one, of the buckets that its rows have; the buckets' numbers are all that
        is collected."""
        spark, folders = batch.sparkSession, self._live(number)
        if not folders:
            return spark.createDataFrame([], f"`{self.key}` string")
        mine = [r[0] for r in batch.where(F.col(self.key).isNotNull()).select(self.bucket()).distinct().collect()]
        return self._read(spark, folders).where(F.col("bucket").isin(mine)).select(self.key)

    def every(self, spark: SparkSession, number: int) -> DataFrame:
        """The keys of all batches before this one."""
        folders = self._live(number)
        return self._read(spark, folders).select(self.key) if folders else spark.createDataFrame([], f"`{self.key}` string")

    def add(self, rows: DataFrame, number: int) -> None:
        """Keys that a batch has made; merges folders when there are many, and drops merged ones of before."""
        self._write(rows.where(F.col(self.key).isNotNull()), f"add={number}")
        live = self._live(number + 1)
        if len(live) > self.most:
            self._write(self._read(rows.sparkSession, live), f"all={number}")
        base = max((n for n in self._folders()["all"] if n < number), default=None)
        if base is not None:  # of a batch before, which is done: what it holds isn't read again
            store, root = storage(self.path)
            for kind, numbers in self._folders().items():
                for n in numbers:
                    if n < base or (kind == "add" and n == base):
                        store.delete_dir(f"{root}/{kind}={n}")
