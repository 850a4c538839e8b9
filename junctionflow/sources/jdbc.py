"""JDBC writes that may be repeated.

Spark's JDBC writer commits task by task, so a batch that fails half-way and is
replayed leaves rows twice. Here a batch's rows first go to a staging table of
their own (written by all tasks, replaced whole by a replay); then one
transaction of the driver moves them with one INSERT ... SELECT inside the
database and notes the batch in a ledger. A batch that the ledger holds is not
moved again. No row passes through the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

LEDGER = "STORED_BATCHES"
_LEDGER_COLUMNS = "TABLE_NAME VARCHAR(128) NOT NULL, RUN VARCHAR(128) NOT NULL, BATCH_ID BIGINT NOT NULL, STORED_ROWS BIGINT NOT NULL, PRIMARY KEY (TABLE_NAME, RUN)"
#: The ledger row by which writers of one table's missing keys take turns.
_BY_KEY = "by-key"
#: Type of text keys in tables that are made here.
KEY_TYPE = "VARCHAR(255)"


class _Database:
    """One driver-side connection, opened by Spark's own dialect for the url."""

    def __init__(self, spark: SparkSession, url: str, props: dict[str, str] | None):
        self.spark, self.url, self.props = spark, url, props or {}
        jvm = spark.sparkContext._jvm
        self.dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
        options = jvm.java.util.HashMap()
        for k, v in self.props.items():
            options.put(k, v)
        settings = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(url, LEDGER, jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(options))
        self.connection = self.dialect.createConnectionFactory(settings).apply(-1)

    def quoted(self, name: str) -> str:
        return self.dialect.quoteIdentifier(name)

    def run(self, sql: str, *values) -> int:
        """Run one statement; rows it changed."""
        s = self.connection.prepareStatement(sql)
        try:
            for k, v in enumerate(values, 1):
                s.setLong(k, v) if isinstance(v, int) else s.setString(k, v)
            return s.executeUpdate()
        finally:
            s.close()

    def any(self, sql: str, *values) -> bool:
        s = self.connection.prepareStatement(sql)
        try:
            for k, v in enumerate(values, 1):
                s.setLong(k, v) if isinstance(v, int) else s.setString(k, v)
            return s.executeQuery().next()
        finally:
            s.close()

    def exists(self, table: str) -> bool:
        try:
            self.any(f"SELECT 1 FROM {table} WHERE 1 = 0")
            return True
        except Exception as e:  # noqa: BLE001 - a missing table is an SQLException of the database's own kind
            if "SQL" not in str(getattr(e, "java_exception", e)):
                raise
            return False

    @contextmanager
    def transaction(self) -> Iterator[None]:
        self.connection.setAutoCommit(False)
        try:
            yield
            self.connection.commit()
        except BaseException:
            self.connection.rollback()
            raise
        finally:
            self.connection.setAutoCommit(True)

    def columns(self, table: str) -> list[str]:
        return _reader(self.spark, self.url, table, self.props).columns


def _reader(spark: SparkSession, url: str, table: str, props: dict[str, str]) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        reader = reader.option(k, v)
    return reader.load()


def _write(df: DataFrame, url: str, table: str, props: dict[str, str], mode: str, keys: list[str] | None) -> None:
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    texts = [f"`{f.name}` {KEY_TYPE}" for f in df.schema.fields if f.name in (keys or ()) and isinstance(f.dataType, StringType)]
    if texts:  # a database need not compare what it makes of a string without a length
        writer = writer.option("createTableColumnTypes", ", ".join(texts))
    for k, v in props.items():
        writer = writer.option(k, v)
    writer.save()


def staging_prefix(table: str, run: str, batch_id: int) -> str:
    """What the names of a batch's staging tables begin with: one table an attempt, so attempts at one time do not mix."""
    return f"STAGE_{hashlib.sha256(f'{table}/{run}/{batch_id}'.encode()).hexdigest()[:16]}_".upper()


def is_stored(db: _Database, table: str, run: str, batch_id: int) -> bool:
    """Whether the run's ledger row has come to this batch (a run numbers its batches upwards)."""
    return db.any(f"SELECT 1 FROM {LEDGER} WHERE TABLE_NAME = ? AND RUN = ? AND BATCH_ID >= ?", table.upper(), run, batch_id)


def _ensure_ledger(db: _Database) -> None:
    if not db.exists(LEDGER):
        try:
            db.run(f"CREATE TABLE {LEDGER} ({_LEDGER_COLUMNS})")
        except Exception:  # noqa: BLE001 - another writer may have made it first
            if not db.exists(LEDGER):
                raise


def _enter(db: _Database, table: str, run: str, batch_id: int) -> None:
    """Set the run's ledger row to this batch, inside a transaction; fails if it is there already."""
    if not db.run(f"UPDATE {LEDGER} SET BATCH_ID = ? WHERE TABLE_NAME = ? AND RUN = ? AND BATCH_ID < ?", batch_id, table.upper(), run, batch_id):
        db.run(f"INSERT INTO {LEDGER} VALUES (?, ?, ?, 0)", table.upper(), run, batch_id)


def _move(db: _Database, df: DataFrame, stage: str, table: str, run: str, keys: list[str] | None = None) -> None:
    """Move the staged rows into the table, inside a transaction."""
    own = {c.lower(): c for c in db.columns(table)}
    into = ", ".join(db.quoted(own[c.lower()]) for c in df.columns)
    rows = f"SELECT {', '.join('s.' + db.quoted(c) for c in df.columns)} FROM {stage} s"
    if keys is not None:
        same = " AND ".join(f"t.{db.quoted(own[k.lower()])} = s.{db.quoted(k)}" for k in keys)
        rows += f" WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})"
    stored = db.run(f"INSERT INTO {table} ({into}) {rows}")
    db.run(f"UPDATE {LEDGER} SET STORED_ROWS = STORED_ROWS + ? WHERE TABLE_NAME = ? AND RUN = ?", stored, table.upper(), run)


def _prepare(db: _Database, df: DataFrame, stage: str, table: str, keys: list[str] | None = None) -> None:
    """Stage the rows; make a missing target with the frame's columns."""
    _write(df, db.url, stage, db.props, "overwrite", keys)
    if not db.exists(table):
        _write(df.limit(0), db.url, table, db.props, "append", keys)
    unknown = {c.lower() for c in df.columns} - {c.lower() for c in db.columns(table)}
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")


def _drop(db: _Database, prefix: str) -> None:
    """Drop the staging tables of a batch, also those that attempts which died have left."""
    for pattern in (prefix + "%", prefix.lower() + "%"):
        found = db.connection.getMetaData().getTables(None, None, pattern, None)
        names = []
        while found.next():
            names.append(found.getString("TABLE_NAME"))
        found.close()
        for name in names:
            db.run(f"DROP TABLE {name}")


def store_once(df: DataFrame, url: str, table: str, run: str, batch_id: int, props: dict[str, str] | None = None) -> bool:
    """Append ``df`` to ``table`` unless this batch of the run was stored before; says whether it was stored now.

    ``run`` names a numbering of batches (a streaming query's id), whose batches
    come in order. The ledger holds one row a table and run: the last batch and
    the rows stored so far. Columns are matched without regard to case.
    """
    db = _Database(df.sparkSession, url, props)
    prefix = staging_prefix(table, run, batch_id)
    stage = prefix + uuid.uuid4().hex[:12].upper()
    try:
        _ensure_ledger(db)
        if not is_stored(db, table, run, batch_id):
            try:
                _prepare(db, df, stage, table)
                with db.transaction():
                    _enter(db, table, run, batch_id)
                    _move(db, df, stage, table, run)
                _drop(db, prefix)
                return True
            except Exception:  # noqa: BLE001 - a second driver may have stored the batch meanwhile: then the ledger refused ours
                if not is_stored(db, table, run, batch_id):
                    raise
        _drop(db, prefix)
        return False
    finally:
        db.connection.close()


def store_missing(df: DataFrame, url: str, table: str, keys: list[str], props: dict[str, str] | None = None) -> None:
    """Append the rows whose key ``table`` does not hold, one a key.

    Writers of one table take turns: each transaction first changes the table's
    ledger row, so two that run at the same time do not both find a key missing.
    """
    db = _Database(df.sparkSession, url, props)
    stage = f"STAGE_{uuid.uuid4().hex[:24]}".upper()
    try:
        _ensure_ledger(db)
        if not is_stored(db, table, _BY_KEY, 0):
            try:
                _enter(db, table, _BY_KEY, 0)
            except Exception:  # noqa: BLE001 - another writer may have made it first
                if not is_stored(db, table, _BY_KEY, 0):
                    raise
        df = df.dropDuplicates(keys)
        _prepare(db, df, stage, table, keys)
        try:
            with db.transaction():
                db.run(f"UPDATE {LEDGER} SET BATCH_ID = BATCH_ID + 1 WHERE TABLE_NAME = ? AND RUN = ?", table.upper(), _BY_KEY)
                _move(db, df, stage, table, _BY_KEY, keys)
        finally:
            _drop(db, stage)
    finally:
        db.connection.close()
