"""Primary keys of a store's tables.

Beside a data folder ``<table>/v-<id>`` stands ``<table>/_keys/v-<id>`` with

* ``keys``: the folder's distinct keys, sorted by their hash within each file, and
* ``bloom``: a blocked Bloom filter of them, one row a block of 512 bits, about ten bits a key.

An append looks its keys up in the filters of the folders it lands beside: each key
meets one block a folder, by an equijoin on (depth, block) whose hits alone come out. Only folders
with a hit are opened, and only their key files; the data is never read. So an append
costs one shuffle of its own keys, and the keys of old rows are moved only where they
may repeat. Everything is built by Spark jobs beside the data; the log entry
that publishes a folder names the depth of its filter.

Keys compare as the source compares them (``CHAR`` without its padding).
"""

from __future__ import annotations

import math
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.chars import as_text
from ledgerline.session import scratch_dir

FOLDER = "_keys"
BITS_PER_KEY = 10
WORDS = 8                 # of 64 bits in a block; a key sets one bit in each
HASH = "__h"
PRIMARY_KEY = "primary_key"


class DuplicateKeys(ValueError):
    """Rows would repeat primary-key values; ``repeated`` if they do so among themselves."""

    def __init__(self, message: str, repeated: bool = False):
        super().__init__(message)
        self.repeated = repeated


def primary_key(struct: T.StructType) -> list[str]:
    """Columns that a declared schema marks as its primary key."""
    return [f.name for f in struct.fields if (f.metadata or {}).get(PRIMARY_KEY)]


def key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The key columns in the form that is compared."""
    fields = {f.name: f for f in df.schema.fields}
    return df.select(*[as_text(fields[c]).alias(c) for c in key])


def _block(depth: str) -> str:
    """A 64-bit hash's block in a filter of 2^depth blocks: its upper bits."""
    return f"CASE WHEN {depth} = 0 THEN 0L ELSE shiftrightunsigned({HASH}, 64 - {depth}) END"


def _bit(word: int) -> str:
    """The bit that a key sets in a word, from a second hash."""
    return f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64({HASH}, 7), {6 * word}) & 63L AS INT))"


class KeyIndex:
    """Key files and filters of the folders of one table."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str]):
        self.spark, self.path, self.key = spark, path, list(key)

    def files(self, folder: str, part: str) -> str:
        return f"{self.path}/{FOLDER}/{folder}/{part}"

    # -- building --------------------------------------------------------------
    def add(self, folder: str, rows: DataFrame, refuse: bool = True) -> int:
        """Write the key files and the filter of a folder that holds ``rows``; its depth.

        One shuffle of the keys, whose counts tell repeats apart from the rest.
        """
        seen = Observation(f"keys-{uuid.uuid4().hex}")
        counted = key_rows(rows, self.key).groupBy(*self.key).agg(F.count(F.lit(1)).alias("n"))
        found = (counted.withColumn(HASH, F.xxhash64(*self.key)).sortWithinPartitions(HASH)
                 .observe(seen, F.count(F.lit(1)).alias("keys"), F.max("n").alias("most")))
        found.select(*self.key, HASH).write.parquet(self.files(folder, "keys"))
        if refuse and (seen.get["most"] or 0) > 1:
            raise DuplicateKeys(f"the rows repeat values of the primary key {self.key}", repeated=True)
        depth = max(0, math.ceil(math.log2(max(1, (seen.get["keys"] or 0) * BITS_PER_KEY / (64 * WORDS)))))
        held = self.spark.read.parquet(self.files(folder, "keys"))
        (held.groupBy(F.expr(_block(str(depth))).alias("block"))
         .agg(*[F.bit_or(F.expr(_bit(k))).alias(f"w{k}") for k in range(WORDS)])
         .withColumns({"folder": F.lit(folder), "depth": F.lit(depth)})
         .write.parquet(self.files(folder, "bloom")))
        return depth

    # -- looking up --------------------------------------------------------------
    def candidates(self, keys: DataFrame, depths: dict[str, int]) -> DataFrame:
        """(key, hash, folder): which folder may hold which of ``keys``, by the filters."""
        blooms = self.spark.read.parquet(*[self.files(f, "bloom") for f in depths])
        sizes = F.array(*[F.lit(d) for d in sorted(set(depths.values()))])
        asked = (keys.withColumn("depth", F.explode(sizes)).withColumn("block", F.expr(_block("depth")))
                 .withColumns({f"b{k}": F.expr(_bit(k)) for k in range(WORDS)}))
        hit = F.lit(True)
        for k in range(WORDS):
            hit = hit & (blooms[f"w{k}"].bitwiseAND(asked[f"b{k}"]) != 0)
        on = (asked["depth"] == blooms["depth"]) & (asked["block"] == blooms["block"]) & hit
        return asked.join(blooms, on).select(*[asked[c] for c in self.key], asked[HASH], blooms["folder"])

    def held(self, folder: str, depths: dict[str, int]) -> tuple[DataFrame | None, list[str]]:
        """The keys of ``folder`` that one of the other folders (with their depths) holds, and
        the folders that had to be opened; None where the filters rule all out."""
        if not depths:
            return None, []
        keys = self.spark.read.parquet(self.files(folder, "keys"))
        found = scratch_dir(self.spark, "key-candidates")
        self.candidates(keys, depths).write.parquet(found)
        maybe = self.spark.read.parquet(found)
        opened = sorted(r.folder for r in maybe.select("folder").distinct().collect())  # at most one a folder
        if not opened:
            return None, []
        old = self.spark.read.parquet(*[self.files(f, "keys") for f in opened])
        return maybe.select(*self.key, HASH).distinct().join(old, [*self.key, HASH], "left_semi").select(*self.key), opened

    def refuse(self, folder: str, depths: dict[str, int]) -> list[str]:
        """Raise if another folder holds a key of ``folder``; the folders that had to be opened."""
        held, opened = self.held(folder, depths)
        if held is not None and held.limit(1).collect():
            raise DuplicateKeys(f"the table already holds values of the primary key {self.key}")
        return opened
