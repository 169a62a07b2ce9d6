"""Tables that change together: a commit log and slice index over a folder.

A store holds the tables of one pipeline (candles, RSI rows, tick rows, state).
Rows are laid out by symbol and slice of ``datetime``; a commit writes the
slices it touches anew, each as one sorted file, into a folder of its own, and
nothing that an earlier commit wrote is changed.  So a slice never gathers
small files, and a commit's cost is that of the slices it touches.

* ``_commits/<id>/<table>/symbol=.../<slice>=.../`` the files of a commit;
* ``_commits/<id>/manifest`` one row per touched (table, symbol, slice): its
  files, rows, smallest and largest time.  This is the slice index: readers
  choose files by it before anything is opened;
* ``_log/<version>`` a small file, written last, that names the manifests which
  make up the version.  It is renamed into place and never replaced, so a
  version is there wholly or not at all, and of two writers that started from
  the same version one gets a ``Conflict``.

A job that ends anywhere before the rename leaves files that no version names:
readers don't see them, a repeat starts from the same version, and ``vacuum``
removes them.  All tables of a version are seen together.

After ``MERGED`` commits a manifest with all entries is written, so a reader
merges a bounded number of them.  The log file and the list of files to read
pass through the driver, one path for a (symbol, slice) that is read, as the
file index of any scan does; rows never do.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MERGED = 32
SLICES = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}  # layout column -> format of its values
_SYMBOL = "_symbol"  # the key inside the files: paths are read without partition discovery
_MANIFEST = "table string, symbol string, slice string, files array<string>, rows long, lo timestamp, hi timestamp, seq long"


class Conflict(RuntimeError):
    """Another writer has committed since this one took its snapshot."""


def slice_of(order: str, by: str):
    return F.date_format(F.col(order).cast("timestamp"), SLICES[by])


@dataclass(frozen=True)
class Snapshot:
    version: int
    by: str
    manifests: list[str]
    schemas: dict[str, str] = field(default_factory=dict)   # of each table, as JSON
    whole: list[str] = field(default_factory=list)           # tables without slices


class Store:
    def __init__(self, spark: SparkSession, path: str, key: str = "symbol", order: str = "datetime"):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order

    # ------------------------------------------------------------ log

    def _fs(self):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return p, p(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        p, fs = self._fs()
        return fs.exists(p(f"{self.path}/_log"))

    def versions(self) -> list[int]:
        p, fs = self._fs()
        if not fs.exists(p(f"{self.path}/_log")):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p(f"{self.path}/_log"))]
        return sorted(int(n) for n in names if n.isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """The newest version (or an older one), None before the first commit."""
        found = self.versions()
        if not found:
            return None
        at = found[-1] if version is None else version
        p, fs = self._fs()
        stream = fs.open(p(f"{self.path}/_log/{at:012d}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(at, **json.loads(text))

    def _publish(self, version: int, told: dict) -> None:
        """Write the log file of ``version``, or raise a Conflict if there is one."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        p, fs = self._fs()
        part, final = p(f"{self.path}/_log/.{uuid.uuid4().hex}"), p(f"{self.path}/_log/{version:012d}")
        out = fs.create(part, False)
        try:
            out.write(bytearray(json.dumps(told).encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(fs.makeQualified(part), fs.makeQualified(final),
                           gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            fs.delete(part, False)
            if fs.exists(final):
                raise Conflict(f"{self.path}: version {version} is another writer's") from e
            raise

    # ------------------------------------------------------------ reading

    def entries(self, snap: Snapshot, table: str | None = None) -> DataFrame:
        """The slice index of a version: the newest entry of each (table, symbol, slice)."""
        m = self.spark.read.schema(_MANIFEST).parquet(*[f"{self.path}/_commits/{c}/manifest" for c in snap.manifests])
        m = m if table is None else m.where(F.col("table") == table)
        if len(snap.manifests) == 1:
            return m
        newest = F.max_by(F.struct("files", "rows", "lo", "hi", "seq"), "seq")
        return m.groupBy("table", "symbol", "slice").agg(newest.alias("e")).select("table", "symbol", "slice", "e.*")

    def read(self, snap: Snapshot, table: str, slices: DataFrame | None = None) -> DataFrame:
        """A table, or its given ``slices`` (symbol, slice) alone."""
        e = self.entries(snap, table)
        if slices is not None:
            e = e.join(slices.select("symbol", "slice").distinct(), ["symbol", "slice"], "left_semi")
        paths = [r[0] for r in e.select(F.explode("files")).collect()]
        schema = T.StructType.fromJson(json.loads(snap.schemas[table]))
        inside = T.StructType([T.StructField(_SYMBOL, f.dataType) if f.name == self.key and table not in snap.whole
                               else f for f in schema.fields])
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(inside).parquet(*[self._literal(f"{self.path}/{x}") for x in paths])
        return found.withColumnRenamed(_SYMBOL, self.key)

    @staticmethod
    def _literal(path: str) -> str:
        """A path whose characters stand for themselves, not for a pattern."""
        return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)

    def slices_of(self, rows: DataFrame, snap: Snapshot) -> DataFrame:
        return rows.select(self.key, slice_of(self.order, snap.by).alias("slice")).distinct()

    def newest_slices(self, snap: Snapshot, table: str, symbols: DataFrame, n: int) -> DataFrame:
        """(symbol, slice): the slices that hold the newest ``n`` rows of each of ``symbols``."""
        e = self.entries(snap, table).join(symbols.select("symbol").distinct(), "symbol", "left_semi")
        later = Window.partitionBy("symbol").orderBy(F.col("lo").desc()).rowsBetween(Window.unboundedPreceding, -1)
        return (e.withColumn("_later", F.coalesce(F.sum("rows").over(later), F.lit(0)))
                .where(F.col("_later") < n).select("symbol", "slice"))

    # ------------------------------------------------------------ writing

    def begin(self, snap: Snapshot | None, by: str | None = None) -> "Commit":
        """A commit on top of ``snap``; None starts the tables anew."""
        if snap is None and by not in SLICES:
            raise ValueError(f"by is one of {sorted(SLICES)}")
        return Commit(self, snap, by or snap.by)

    def vacuum(self, keep: int = 2) -> int:
        """Remove what the newest ``keep`` versions don't name: older log files,
        and the folders of commits' tables.  Not while a writer is at work.
        Returns how many folders went."""
        p, fs = self._fs()
        found = self.versions()
        kept = [self.snapshot(v) for v in found[-keep:]]
        live = {(c, "manifest") for s in kept for c in s.manifests}
        for s in kept:
            folder = F.regexp_extract("f", "^_commits/([^/]+)/", 1)
            live |= {(r.c, r.table) for r in self.entries(s).select("table", F.explode("files").alias("f")).select(
                "table", folder.alias("c")).distinct().collect()}
        for v in found[:-keep]:
            fs.delete(p(f"{self.path}/_log/{v:012d}"), False)
        gone = 0
        for commit in fs.listStatus(p(f"{self.path}/_commits")):
            for table in fs.listStatus(commit.getPath()):
                if (commit.getPath().getName(), table.getPath().getName()) not in live:
                    fs.delete(table.getPath(), True)
                    gone += 1
            if not fs.listStatus(commit.getPath()):
                fs.delete(commit.getPath(), False)
        return gone


class Commit:
    """Slices written for one version, seen by nobody until ``commit``."""

    def __init__(self, store: Store, snap: Snapshot | None, by: str):
        self.store, self.snap, self.by = store, snap, by
        self.id = uuid.uuid4().hex
        self.schemas = dict(snap.schemas) if snap else {}
        self.whole = list(snap.whole) if snap else []
        self.staged: list[DataFrame] = []

    def folder(self, table: str) -> str:
        return f"{self.store.path}/_commits/{self.id}/{table}"

    def _kept(self, table: str, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns and types that the table already has."""
        if table in self.schemas:
            was = T.StructType.fromJson(json.loads(self.schemas[table]))
            rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in was.fields])
        self.schemas[table] = json.dumps(rows.schema.jsonValue())
        return rows

    def _files(self, table: str) -> DataFrame:
        fields = T.StructType.fromJson(json.loads(self.schemas[table])).fields
        inside = T.StructType([T.StructField(_SYMBOL, f.dataType) if f.name == self.store.key and table not in self.whole
                               else f for f in fields])
        return self.store.spark.read.schema(inside).option("recursiveFileLookup", "true").parquet(self.folder(table))

    def write(self, table: str, rows: DataFrame) -> None:
        """The whole new content of every slice that ``rows`` has rows of."""
        s = self.store
        rows = self._kept(table, rows)
        (rows.withColumn(_SYMBOL, F.col(s.key)).withColumn(self.by, slice_of(s.order, self.by))
         .repartition(s.key, self.by).sortWithinPartitions(s.key, self.by, s.order)
         .write.partitionBy(s.key, self.by).parquet(self.folder(table)))
        self.staged.append(self._entry(table, F.col(_SYMBOL), slice_of(s.order, self.by), s.order))

    def write_whole(self, table: str, rows: DataFrame) -> None:
        """A small table without slices, a row per key, replaced as a whole."""
        self.whole = sorted({*self.whole, table})
        self._kept(table, rows).write.parquet(self.folder(table))
        none = F.lit(None).cast("string")
        self.staged.append(self._entry(table, none, none, None))

    def read(self, table: str) -> DataFrame:
        """What this commit has written of a table."""
        found = self._files(table)
        return found.withColumnRenamed(_SYMBOL, self.store.key) if table not in self.whole else found

    def _entry(self, table: str, symbol, part, order: str | None) -> DataFrame:
        # paths inside the store; the metadata has them URL-encoded
        inside = F.regexp_extract(F.col("_metadata.file_path"), f"(_commits/{self.id}/.*)$", 1)
        inside = F.url_decode(F.replace(inside, F.lit("+"), F.lit("%2B")))
        time = F.col(order).cast("timestamp") if order else F.lit(None).cast("timestamp")
        return self._files(table).groupBy(symbol.alias("symbol"), part.alias("slice")).agg(
            F.sort_array(F.collect_set(inside)).alias("files"), F.count(F.lit(1)).alias("rows"),
            F.min(time).alias("lo"), F.max(time).alias("hi")).withColumn("table", F.lit(table))

    def commit(self) -> int:
        """Make the written slices the store's next version."""
        s, version = self.store, (self.snap.version if self.snap else max(self.store.versions(), default=0)) + 1
        columns = [f.split()[0] for f in _MANIFEST.split(", ")]
        empty = s.spark.createDataFrame([], _MANIFEST)
        new = empty
        for e in self.staged:
            new = new.unionByName(e.withColumn("seq", F.lit(version).cast("long")).select(columns))
        before = self.snap.manifests if self.snap else []
        if len(before) >= MERGED:
            keys = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("table", "symbol", "slice")]
            touched = new.select(*[F.col(c).alias(f"_{c}") for c in ("table", "symbol", "slice")])
            new = new.unionByName(s.entries(self.snap).join(touched, keys, "left_anti").select(columns))
            before = []
        new.write.parquet(self.folder("manifest"))
        s._publish(version, {"by": self.by, "manifests": [*before, self.id], "schemas": self.schemas, "whole": self.whole})
        return version
