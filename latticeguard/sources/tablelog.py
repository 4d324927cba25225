"""Tables under a commit log, and a key-ranged table that is merged into.

A log is a folder with data files and numbered manifests. A manifest names the files of all tables;
only files that the newest manifest names exist for readers, so a writer that dies before its
manifest leaves nothing behind but unread files. Manifest n + 1 is put in place only if it is absent;
a writer that loses that race works its change out again from the winner's state. A change to
several tables is one manifest, so readers see all of it or nothing. Earlier manifests stay
readable: a reader can ask for the state at any version.

Putting a manifest needs one atomic step of the storage: a rename that fails if the target is there
(HDFS and alike), or a hard link on a local disk.
"""
from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release

#: Attempts of a change before its writer gives up.
ATTEMPTS = 20
#: Rows a file of a key-ranged table is meant to hold.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class State:
    """What one manifest says: its number, and the entries ({"path": ...}) of each table."""

    version: int = 0
    tables: dict[str, list[dict]] = field(default_factory=dict)

    def entries(self, table: str) -> list[dict]:
        return self.tables.get(table, [])


class TableLog:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._log = f"{self.root}/_log"
        self._fs.mkdirs(self._path(self._log))

    # --- reading --------------------------------------------------------------------

    def versions(self) -> list[int]:
        names = (s.getPath().getName() for s in self._fs.listStatus(self._path(self._log)))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def state(self, version: int | None = None) -> State:
        """The newest state, or that of a version (0: before the first change)."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if not version:
            return State()
        if version not in known:
            raise ValueError(f"no version {version}")
        stream = self._fs.open(self._path(self._manifest(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(version, json.loads(text)["tables"])

    def read(self, table: str, state: State | None = None) -> DataFrame:
        """Rows of a table, now or in an earlier state."""
        return self.rows(table, (state or self.state()).entries(table))

    def rows(self, table: str, entries: list[dict]) -> DataFrame:
        schema = self.schemas[table]
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{e['path']}" for e in entries))

    # --- writing --------------------------------------------------------------------

    def write(self, table: str, rows: DataFrame) -> list[dict]:
        """Write a table's columns of `rows` as new files, which no reader sees yet; their entries."""
        path = f"data/{table}/{uuid.uuid4().hex}"
        self._aligned(table, rows).write.parquet(f"{self.root}/{path}")
        return [{"path": path}]

    def _aligned(self, table: str, rows: DataFrame) -> DataFrame:
        schema = self.spark.createDataFrame([], self.schemas[table]).schema
        return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))

    def commit(self, change: Callable[[State], dict[str, list[dict]] | None]) -> State:
        """Apply a change: given the newest state, it writes files and returns the entries of the tables that
        it alters (None: nothing to do). It is called again whenever another writer was faster."""
        for _ in range(ATTEMPTS):
            state = self.state()
            altered = change(state)
            if altered is None:
                return state
            following = State(state.version + 1, state.tables | altered)
            if self._put(following):
                return following
        raise RuntimeError(f"{ATTEMPTS} writers were faster")

    def append(self, **rows: DataFrame) -> State:
        """Append rows to one or more tables, in one change; they are written once, however many attempts it takes."""
        new = {table: self.write(table, r) for table, r in rows.items()}
        return self.commit(lambda state: {table: state.entries(table) + e for table, e in new.items()})

    def _manifest(self, version: int) -> str:
        return f"{self._log}/{version:020d}.json"

    def _put(self, state: State) -> bool:
        """Put a manifest in place if its number is free."""
        jvm, target = self.spark._jvm, self._path(self._manifest(state.version))
        draft = self._path(f"{self._log}/_draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps({"version": state.version, "tables": state.tables}).encode()))
        finally:
            stream.close()
        try:
            if self._fs.getScheme() == "file":
                link, made = (jvm.java.nio.file.Paths.get(self._fs.makeQualified(p).toUri()) for p in (target, draft))
                jvm.java.nio.file.Files.createLink(link, made)
                return True
            return self._fs.rename(draft, target)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                return False
            raise
        finally:
            self._fs.delete(draft, False)

    def vacuum(self, keep: int = 1) -> int:
        """Forget all but the newest `keep` versions and delete the files that no kept one names; how many folders
        went. Not for use while a writer is at work: its files aren't named yet."""
        versions = self.versions()
        named = {e["path"].rsplit("/part-", 1)[0] for v in versions[-keep:] for es in self.state(v).tables.values() for e in es}
        for version in versions[:-keep]:
            self._fs.delete(self._path(self._manifest(version)), False)
        gone, data = 0, self._path(f"{self.root}/data")
        for table in self._fs.listStatus(data) if self._fs.exists(data) else []:
            for folder in self._fs.listStatus(table.getPath()):
                if f"data/{table.getPath().getName()}/{folder.getPath().getName()}" not in named:
                    gone += self._fs.delete(folder.getPath(), True)
        return gone


class KeyedTable:
    """A table of a log whose files hold ranges of a key; a merge rewrites only files that it changes.

    Entries carry the smallest key of their file (`low`), in key order: a file's range ends where the next one
    begins. Key columns are strings or integers and never null. The list of files is part of the manifest and
    goes to every task: one entry per FILE_ROWS rows.
    """

    def __init__(self, log: TableLog, table: str, keys: list[str], file_rows: int = FILE_ROWS):
        self.log, self.table, self.keys, self.file_rows = log, table, keys, file_rows

    def read(self, state: State | None = None) -> DataFrame:
        return self.log.read(self.table, state)

    def _write(self, rows: DataFrame) -> list[dict]:
        """New files of at most about `file_rows` rows each, cut at keys, with their entries in key order."""
        held = materialize(self.log._aligned(self.table, rows), f"merge-{self.table}")
        n = max(1, -(-held.count() // self.file_rows))
        (written,) = self.log.write(self.table, held.repartitionByRange(n, *self.keys).sortWithinPartitions(*self.keys))
        release(held)
        key = F.struct(*self.keys)
        files = self.log.rows(self.table, [written]).groupBy(F.input_file_name().alias("file")).agg(
            F.min(key).alias("low"), F.count(F.lit(1)).alias("rows")).orderBy("low").collect()
        return [{"path": f"{written['path']}/{f['file'].rsplit('/', 1)[1]}", "low": list(f["low"]), "rows": f["rows"]} for f in files]

    def _file_of(self, entries: list[dict]) -> Column:
        """The number of the file that a row's key belongs to."""
        lows = [tuple(e["low"]) for e in entries]

        @F.arrow_udf("int")
        def place(*columns):
            import pyarrow as pa

            rows = zip(*(c.to_pylist() for c in columns), strict=True)
            return pa.array([max(0, bisect_right(lows, row) - 1) for row in rows], pa.int32())

        return place(*self.keys)

    def merge(self, batch: DataFrame, recency: str | None = None) -> tuple[State, int]:
        """Upsert a batch: the state after it, and how many files were rewritten.

        Of several rows of a key, the one with the highest `recency` wins (ties by the row's values). A batch
        that changes nothing writes nothing, so applying a batch twice equals applying it once.
        """
        from ..operators.graph import upsert

        empty = self.log.rows(self.table, [])
        once = materialize(upsert(empty, batch, self.keys, recency), f"batch-{self.table}")
        if once.where(" OR ".join(f"`{k}` IS NULL" for k in self.keys)).limit(1).count():
            raise ValueError("a key must not be null")
        touched: list[int] = []

        def change(state: State) -> dict[str, list[dict]] | None:
            entries = state.entries(self.table)
            touched.clear()
            if not entries:
                return {self.table: self._write(once)} if once.limit(1).count() else None
            dealt = once.withColumn("_file", self._file_of(entries))
            maybe = sorted(r[0] for r in dealt.select("_file").distinct().collect())
            present = self.log.rows(self.table, [entries[i] for i in maybe])
            same = [once[c].eqNullSafe(present[c]) for c in present.columns]
            news = materialize(once.join(present, same, "left_anti"), f"news-{self.table}")
            touched.extend(sorted(r[0] for r in news.select(self._file_of(entries).alias("f")).distinct().collect()))
            if not touched:
                return None
            old = self.log.rows(self.table, [entries[i] for i in touched])
            new = self._write(upsert(old, news, self.keys))
            release(news)
            kept = [e for i, e in enumerate(entries) if i not in set(touched)]
            return {self.table: sorted(kept + new, key=lambda e: e["low"])}

        state = self.log.commit(change)
        release(once)
        return state, len(touched)
