"""Live tables in a relational database, through Spark's built-in JDBC source.

The same read and append surface as :class:`TableStore`, so the label sync,
backups and reloads can run against tables kept in a PostgreSQL database, while
snapshots go to a file store (``backup_store=``). Enumerated types come from the
database's catalog. Replacing a whole table is refused. Written against the
documented options and catalogs, and tested with a stub reader: no database
has been reached.

Scale: a JDBC read is one task unless the table has a numeric or date
``partitionColumn`` with bounds (``partitions=``); give one for large tables.
Appends write in parallel, one connection per task.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.enums import EnumType, with_enum
from ledgerline.sources.store import TableNotFound

# TRUNCATE followed by INSERT would leave an empty table if the second fails.
_NO_REPLACE = "replacing a database table is not one transaction over JDBC; do it in the database"


class JdbcTableStore:
    fmt = "jdbc"

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str] | None = None,
                 partitions: Mapping[str, Mapping[str, str]] | None = None):
        """``partitions``: per ``"schema.table"``, Spark JDBC read options
        (``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``)."""
        self.spark = spark
        self.url = url
        self.properties = dict(properties or {})
        self.partitions = {k: dict(v) for k, v in (partitions or {}).items()}

    @classmethod
    def from_env(cls, spark: SparkSession, env: Mapping[str, str] | None = None,
                 **kwargs) -> "JdbcTableStore":
        """A PostgreSQL store from the standard ``PGHOST``, ``PGPORT``,
        ``PGDATABASE``, ``PGUSER`` and ``PGPASSWORD`` variables.

        ``stringtype=unspecified`` lets the server cast text values into
        enumerated columns on insert.
        """
        env = os.environ if env is None else env
        host, port = env.get("PGHOST", "localhost"), env.get("PGPORT", "5432")
        db = env.get("PGDATABASE", "postgres")
        props = {"driver": "org.postgresql.Driver", "stringtype": "unspecified"}
        if env.get("PGUSER"):
            props["user"] = env["PGUSER"]
        if env.get("PGPASSWORD"):
            props["password"] = env["PGPASSWORD"]
        return cls(spark, f"jdbc:postgresql://{host}:{port}/{db}", props, **kwargs)

    # -- options ---------------------------------------------------------------
    def options(self, **extra: str) -> dict[str, str]:
        opts = {"url": self.url, **self.properties}
        opts.update({k: v for k, v in extra.items() if v is not None})
        return opts

    def _reader(self, **extra: str):
        return self.spark.read.format("jdbc").options(**self.options(**extra))

    @staticmethod
    def _quote(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def _catalog_query(self, schema: str, table: str | None = None) -> str:
        q = ("SELECT table_name FROM information_schema.tables "
             f"WHERE table_schema = {self._quote(schema)} AND table_type = 'BASE TABLE'")
        if table is not None:
            q += f" AND table_name = {self._quote(table)}"
        return q

    # -- catalog -----------------------------------------------------------------
    def path(self, schema: str, table: str) -> str:
        return f"{schema}.{table}"

    def exists(self, schema: str, table: str) -> bool:
        return self._reader(query=self._catalog_query(schema, table)).load().count() > 0

    def tables(self, schema: str) -> list[str]:
        # Catalog-sized: one row per table.
        return sorted(r[0] for r in self._reader(query=self._catalog_query(schema)).load().collect())

    def enums(self, schema: str, table: str) -> dict[str, EnumType]:
        """Enumerated columns from the database's catalog, labels in declaration order."""
        rows = self._reader(query=self._enum_query(schema, table)).load().collect()  # one row per label
        types: dict[str, tuple[str, list]] = {}
        for r in rows:
            types.setdefault(r["column_name"], (r["type_name"], []))[1].append((r["place"], r["label"]))
        return {c: EnumType(name, tuple(v for _, v in sorted(labels))) for c, (name, labels) in types.items()}

    def _enum_query(self, schema: str, table: str) -> str:
        return ("SELECT a.attname AS column_name, t.typname AS type_name, e.enumsortorder AS place, e.enumlabel AS label "
                "FROM pg_attribute a JOIN pg_type t ON t.oid = a.atttypid JOIN pg_enum e ON e.enumtypid = t.oid "
                "JOIN pg_class c ON c.oid = a.attrelid JOIN pg_namespace n ON n.oid = c.relnamespace "
                f"WHERE n.nspname = {self._quote(schema)} AND c.relname = {self._quote(table)} AND a.attnum > 0")

    # -- reads ---------------------------------------------------------------------
    def read(self, schema: str, table: str) -> DataFrame:
        if not self.exists(schema, table):
            raise TableNotFound(f"table {schema}.{table} does not exist")
        df = self._reader(dbtable=self.path(schema, table),
                          **self.partitions.get(self.path(schema, table), {})).load()
        for c, e in self.enums(schema, table).items():  # a plain text column to Spark
            if c in df.columns:
                df = with_enum(df, c, e)
        return df

    def schema_of(self, schema: str, table: str) -> T.StructType:
        return self.read(schema, table).schema

    # -- writes --------------------------------------------------------------------
    def _write(self, df: DataFrame, schema: str, table: str, mode: str, observe: bool) -> int | None:
        obs = None
        if observe:
            obs = Observation(f"rows-{uuid.uuid4().hex}")
            df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        df.write.format("jdbc").options(**self.options(dbtable=self.path(schema, table))).mode(mode).save()
        return int(obs.get["rows"]) if obs is not None else None

    def append(self, df: DataFrame, schema: str, table: str, observe: bool = True) -> int | None:
        """INSERT by column name: aligned to the table's schema first."""
        from ledgerline.operators.labels import align_to

        target = self.schema_of(schema, table)
        return self._write(align_to(df, target), schema, table, "append", observe)

    def write(self, df: DataFrame, schema: str, table: str, mode: str = "overwrite", observe: bool = False) -> int | None:
        raise NotImplementedError(_NO_REPLACE)

    def rewrite(self, schema: str, table: str, fn: Callable[[DataFrame], DataFrame]) -> int:
        raise NotImplementedError(_NO_REPLACE)

    def truncate(self, schema: str, table: str) -> None:
        raise NotImplementedError(_NO_REPLACE)

    def create_schema(self, schema: str) -> None:
        raise NotImplementedError("schemas of a database are created by its administrator")
