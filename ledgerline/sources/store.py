"""A table store of Parquet directories: ``<root>/<schema>/<table>/``.

It stands in for the source's database schemas (a live schema and a backup
schema). Reads and writes are ordinary ``spark.read`` / ``df.write`` jobs.

Every write goes to a new folder ``v-<id>`` and becomes visible with one small
file, written last: ``_log/<number>.json`` lists the folders that make up the
table and its schema (with field metadata: enum domains, defaults, constraints).
A reader takes the file of the highest number; nothing is ever renamed, so it
sees a state before or after a write, never between, and a failed or lost
write leaves only a folder that no file names. A writer whose number was taken
meanwhile does not overwrite the other's work: an append is published again on
top of it, a replacement made from an older state raises
:class:`ConcurrentWrite`. :meth:`TableStore.vacuum` removes what is not named.

A declared primary key holds on every append, see :mod:`ledgerline.sources.keys`: rows that
repeat a key among themselves or one of the table raise :class:`DuplicateKeys` and
nothing becomes visible, whoever appends at the same time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.chars import as_text
from ledgerline.functions.rows import empty_frame
from ledgerline.sources import fs, keys
from ledgerline.sources.keys import DuplicateKeys, KeyIndex, key_rows, primary_key  # noqa: F401

LOG = "_log"
RETRIES = 20


class TableNotFound(LookupError):
    """A table the operation needs does not exist."""


class ConcurrentWrite(RuntimeError):
    """Another writer has published the table since it was read."""


@dataclass(frozen=True)
class Head:
    """The published state of a folder: 0 and nothing before the first write.
    ``depths``: names of key files (the folder's, or that and a suffix), and the depth of their filter."""

    number: int
    folders: tuple[str, ...] = ()
    schema: T.StructType | None = None
    depths: dict[str, int] = field(default_factory=dict)

    def added_to(self, old: Head) -> tuple[str, ...] | None:
        """Folders that came since ``old`` by appends alone; None if the table was replaced."""
        n = len(old.folders)
        return self.folders[n:] if self.schema == old.schema and self.folders[:n] == old.folders else None


class TableStore:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # -- naming --------------------------------------------------------------
    def path(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}"

    def exists(self, schema: str, table: str) -> bool:
        return self.head(self.path(schema, table)).number > 0

    def schema_exists(self, schema: str) -> bool:
        return fs.exists(self.spark, f"{self.root}/{schema}")

    def tables(self, schema: str) -> list[str]:
        return [t for t in fs.list_dirs(self.spark, f"{self.root}/{schema}") if self.exists(schema, t)]

    def create_schema(self, schema: str) -> None:
        fs.mkdirs(self.spark, f"{self.root}/{schema}")

    def drop_schema(self, schema: str) -> bool:
        """Drop a schema and every table in it (``DROP SCHEMA ... CASCADE``)."""
        return fs.delete(self.spark, f"{self.root}/{schema}")

    # -- publishing ------------------------------------------------------------
    def head(self, path: str) -> Head:
        """The state that readers see."""
        for _ in range(RETRIES):
            numbers = self._log_numbers(path)
            try:
                for number in reversed(numbers):
                    text = fs.read_text(self.spark, self._log_file(path, number))
                    if text.endswith("\n"):  # a file still being written is not published yet
                        entry = json.loads(text)
                        struct = T.StructType.fromJson(entry["schema"]) if entry["schema"] else None
                        return Head(number, tuple(entry["folders"]), struct, entry.get("depths") or {})
                return Head(0)
            except Exception:
                if fs.exists(self.spark, self._log_file(path, number)):
                    raise
                # overtaken and cleaned up since the listing: list again
        raise ConcurrentWrite(f"the log of {path} was cleaned up {RETRIES} times while it was read")

    def _log_file(self, path: str, number: int) -> str:
        return f"{path}/{LOG}/{number:010d}.json"

    def _log_numbers(self, path: str) -> list[int]:
        return sorted(int(n[:-5]) for n in fs.list_files(self.spark, f"{path}/{LOG}") if n.endswith(".json") and n[:-5].isdigit())

    def publish(self, path: str, after: Head, folders: tuple[str, ...], struct: T.StructType | None,
                depths: dict[str, int] | None = None) -> bool:
        """Make ``folders`` the content of ``path``, if ``after`` is still its state."""
        entry = {"folders": list(folders), "schema": json.loads(struct.json()) if struct is not None else None,
                 "depths": {name: d for name, d in (depths or {}).items() if name.partition(".")[0] in folders}}
        return fs.create_text(self.spark, self._log_file(path, after.number + 1), json.dumps(entry) + "\n")

    def new_folder(self) -> str:
        return f"v-{uuid.uuid4().hex}"

    def vacuum(self, path: str) -> int:
        """Delete folders and log files that the published state does not need. Not while others write."""
        head, gone = self.head(path), 0
        for d in fs.list_dirs(self.spark, path):
            if d.startswith("v-") and d not in head.folders:
                gone += fs.delete(self.spark, f"{path}/{d}")
        for d in fs.list_dirs(self.spark, f"{path}/{keys.FOLDER}"):
            if d not in head.depths:
                fs.delete(self.spark, f"{path}/{keys.FOLDER}/{d}")
        for number in self._log_numbers(path):
            if number < head.number:
                fs.delete(self.spark, self._log_file(path, number))
        return gone

    # -- reads ---------------------------------------------------------------
    def read(self, schema: str, table: str) -> DataFrame:
        return self._load(self.path(schema, table), self._head_of(schema, table))

    def _head_of(self, schema: str, table: str) -> Head:
        head = self.head(self.path(schema, table))
        if not head.number:
            raise TableNotFound(f"table {schema}.{table} does not exist")
        return head

    def _load(self, path: str, head: Head) -> DataFrame:
        if not head.folders:
            return empty_frame(self.spark, head.schema)
        df = self.spark.read.format(self.fmt).schema(head.schema).load([f"{path}/{d}" for d in head.folders])
        for f in head.schema.fields:
            if f.metadata and df.schema[f.name].metadata != f.metadata:
                df = df.withMetadata(f.name, f.metadata)
        return df

    def schema_of(self, schema: str, table: str) -> T.StructType:
        return self._head_of(schema, table).schema

    # -- writes --------------------------------------------------------------
    def _save(self, df: DataFrame, path: str, observe: bool) -> int | None:
        obs = None
        if observe:
            obs = Observation(f"rows-{uuid.uuid4().hex}")
            df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        df.write.format(self.fmt).mode("errorifexists").save(path)
        return int(obs.get["rows"]) if obs is not None else None

    def _replace(self, df: DataFrame, path: str, after: Head, observe: bool, what: str) -> int | None:
        folder = self.new_folder()
        rows = self._save(df, f"{path}/{folder}", observe)
        if not self.publish(path, after, (folder,), _nullable(df.schema)):
            raise ConcurrentWrite(f"{what} was changed by another writer")
        return rows

    def write(self, df: DataFrame, schema: str, table: str, mode: str = "overwrite",
              observe: bool = False) -> int | None:
        """Create or replace a table (``mode='error'`` refuses to replace)."""
        if mode not in ("overwrite", "error", "errorifexists"):
            raise ValueError(mode)
        path = self.path(schema, table)
        head = self.head(path)
        if mode != "overwrite" and head.number:
            raise FileExistsError(f"table {schema}.{table} exists")
        return self._replace(df, path, head, observe, f"{schema}.{table}")

    def create(self, schema: str, table: str, struct: T.StructType, if_not_exists: bool = False) -> bool:
        """An empty table with a declared schema (field metadata kept).

        Replaces an existing table, unless ``if_not_exists`` (then an existing
        table and its rows are kept). Returns whether a table was created.
        """
        path = self.path(schema, table)
        head = self.head(path)
        if if_not_exists and head.number:
            return False
        if not self.publish(path, head, (), struct):
            raise ConcurrentWrite(f"{schema}.{table} was changed by another writer")
        return True

    def append(self, df: DataFrame, schema: str, table: str, observe: bool = True,
               after: Head | None = None, unique: bool = True, new_by: Sequence[str] | None = None) -> int | None:
        """Append rows by column name; returns the number appended.

        Rows are aligned to the table's schema first (an INSERT with a column
        list): target columns the rows lack take their declared default or
        NULL, types are cast, constraints hold, and a column the table lacks is
        an error. All rows become visible at once. With ``after`` the table
        must still be in that state (what was checked against it holds).

        The declared primary key holds unless ``unique`` is false: against the
        folders that were there, and against those of appends that were
        published meanwhile. ``new_by`` says that the rows are new by these
        columns as of ``after``; if others appended since, the rows whose
        key they brought are left out rather than refused.
        """
        from ledgerline.operators.labels import align_to

        path, head = self.path(schema, table), after or self._head_of(schema, table)
        df = align_to(df, head.schema)
        folder = self.new_folder()
        key = primary_key(head.schema) if unique else []
        index = KeyIndex(self.spark, path, key)
        depths: dict[str, int] = {}
        try:
            rows = self._save(df, f"{path}/{folder}", observe)
            if key:
                own = {folder: index.add(folder, self._folder(path, folder, head))}
                depths = self._key_files(index, head, head.folders)
                index.refuse(folder, depths)
                depths |= own
            for _ in range(RETRIES):
                if self.publish(path, head, (*head.folders, folder), head.schema, {**head.depths, **depths}):
                    return rows
                now = self._head_of(schema, table)
                added = now.added_to(head)
                if now.schema != head.schema or after is not None and (added is None or not new_by):
                    break
                fresh = now.folders if added is None else added
                if new_by and after is not None:
                    folder, rows = self._leave_out(path, head, folder, fresh, list(new_by), rows)
                if key:
                    if folder not in depths:
                        depths[folder] = index.add(folder, self._folder(path, folder, head))
                    others = self._key_files(index, now, fresh)
                    index.refuse(folder, others)
                    depths |= others
                head = now
        except Exception:
            self._discard(path, folder)
            raise
        self._discard(path, folder)
        raise ConcurrentWrite(f"{schema}.{table} was changed by another writer")

    def append_planned(self, plan: Callable[[DataFrame], DataFrame], schema: str, table: str, observe: bool = True,
                       new_by: Sequence[str] | None = None) -> int | None:
        """Append ``plan(the table as it stands)``, on just the state that the plan read.

        If another writer comes first the plan is made again from the new state; with
        ``new_by`` (the plan's rows are new by these columns) rows staged before
        others' appends are kept and only held against those appends. Either way
        two runs at once leave what one after the other would have left.
        """
        for _ in range(RETRIES):
            head = self._head_of(schema, table)
            df = plan(self._load(self.path(schema, table), head))
            try:
                return self.append(df, schema, table, observe, after=head, new_by=new_by)
            except ConcurrentWrite:
                continue
        raise ConcurrentWrite(f"{schema}.{table} was changed by other writers {RETRIES} times")

    def _folder(self, path: str, folder: str, head: Head) -> DataFrame:
        return self._load(path, Head(head.number, (folder,), head.schema))

    def _key_files(self, index: KeyIndex, head: Head, folders: Sequence[str]) -> dict[str, int]:
        """Key files of the folders and the depths of their filters. Those that a replacement wrote get
        key files now, under a name of this append's own: others may be at it too."""
        named = {name.partition(".")[0]: name for name in head.depths}
        out = {}
        for f in folders:
            if f in named:
                out[named[f]] = head.depths[named[f]]
            else:
                name = f"{f}.{uuid.uuid4().hex[:8]}"
                out[name] = index.add(name, self._folder(index.path, f, head), refuse=False)
        return out

    def _leave_out(self, path: str, head: Head, folder: str, added: Sequence[str], key: list[str],
                   rows: int | None) -> tuple[str, int | None]:
        """``folder`` without the rows whose key is in ``added``: itself, or a new folder."""
        if not added:
            return folder, rows
        known = key_rows(self._load(path, Head(head.number, tuple(added), head.schema)), key).distinct()
        own = self._folder(path, folder, head)
        tagged = own.withColumns({f"__{c}": as_text(own.schema[c]) for c in key})
        if tagged.join(known, [F.col(f"__{c}") == known[c] for c in key], "left_semi").isEmpty():
            return folder, rows
        left = tagged.join(known, [F.col(f"__{c}") == known[c] for c in key], "left_anti").select(*own.columns)
        other = self.new_folder()
        n = self._save(left, f"{path}/{other}", True)
        self._discard(path, folder)
        return other, n if rows is not None else None

    def _discard(self, path: str, folder: str) -> None:
        """Delete a folder that was not published."""
        fs.delete(self.spark, f"{path}/{folder}")
        fs.delete(self.spark, f"{path}/{keys.FOLDER}/{folder}")

    def rewrite(self, schema: str, table: str, fn: Callable[[DataFrame], DataFrame]) -> int:
        """Replace a table by a function of itself; raises if it was changed meanwhile."""
        path, head = self.path(schema, table), self._head_of(schema, table)
        return self._replace(fn(self._load(path, head)), path, head, True, f"{schema}.{table}") or 0

    def drop(self, schema: str, table: str) -> bool:
        return fs.delete(self.spark, self.path(schema, table))

    def truncate(self, schema: str, table: str) -> None:
        self.create(schema, table, self.schema_of(schema, table))


def _nullable(struct: T.StructType) -> T.StructType:
    """The schema as files give it back."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in struct.fields])
