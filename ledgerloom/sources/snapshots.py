"""Tables that change together, and only as a whole.

A write goes to a folder of its own and is seen by nobody. Publishing adds one small file to the log that says which folder holds
each partition of each table; readers follow the last file of the log. So a batch, the run that posted it and all else of one run
appear at the same moment or, if the run breaks off anywhere before, not at all. Partitions a run does not touch keep their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources import files
from ledgerloom.sources.sinks import clustered, conform

#: What Spark escapes in the folder name of a partition value.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(32)}


def partition_folder(values: Mapping[str, object]) -> str:
    """The folder Spark writes a partition to."""
    def text(value) -> str:
        if value is None or str(value) == "":
            return "__HIVE_DEFAULT_PARTITION__"
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))

    return "/".join(f"{k}={text(v)}" for k, v in values.items())


@dataclass(frozen=True)
class Table:
    """Schema, partition columns, and the commit that holds each partition's rows."""

    schema: str
    partition_by: tuple[str, ...]
    partitions: Mapping[str, str]


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    tables: Mapping[str, Table] = field(default_factory=dict)


@dataclass(frozen=True)
class Written:
    """A folder that is written but not yet published."""

    table: str
    commit: str
    schema: str
    partition_by: tuple[str, ...]
    partitions: tuple[str, ...]


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- reading -----------------------------------------------------------

    def latest(self) -> Snapshot:
        """The last published state; an empty one before the first."""
        log = [n for n in files.names(self.spark, f"{self.root}/log") if n.endswith(".json") and not n.startswith(".")]
        return self.at(int(log[-1][:-5])) if log else Snapshot()

    def at(self, number: int) -> Snapshot:
        said = json.loads(files.read_text(self.spark, f"{self.root}/log/{number:012d}.json"))
        return Snapshot(number, {name: Table(t["schema"], tuple(t["partition_by"]), t["partitions"]) for name, t in said.items()})

    def read(self, table: str, schema: str, snapshot: Snapshot | None = None, partitions: Collection[str] | None = None) -> DataFrame:
        """A table as a snapshot has it, the last one by default; no rows where it was never published.

        Partition columns come from the folders, so filters and dynamic pruning on them skip whole folders. ``partitions`` reads
        only those.
        """
        known = (snapshot or self.latest()).tables.get(table)
        wanted = {} if known is None else {p: c for p, c in known.partitions.items() if partitions is None or p in partitions}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/data/{table}"
        paths = [f"{base}/commit={commit}/{p}".rstrip("/") for p, commit in wanted.items()]
        names = [f.name for f in StructType.fromDDL(schema)]
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*names)

    # --- writing -----------------------------------------------------------

    def write(self, df: DataFrame, table: str, schema: str, partition_by: Sequence[str] = ()) -> Written:
        """Write rows aside. Nothing reads them until they are published."""
        commit = uuid.uuid4().hex
        path = f"{self.root}/data/{table}/commit={commit}"
        rows = conform(df, schema)
        if partition_by:
            clustered(rows, partition_by).write.partitionBy(*partition_by).parquet(path)
            found = tuple(files.folders(self.spark, path, len(partition_by)))
        else:
            rows.hint("rebalance").write.parquet(path)
            found = ("",)
        return Written(table, commit, schema, tuple(partition_by), found)

    def publish(self, base: Snapshot, written: Sequence[Written], emptied: Mapping[str, Collection[str]] | None = None) -> Snapshot:
        """Make all of it visible at once.

        Each partition written replaces the one of its name; those ``emptied`` lists by table and not written are gone, all others stay.
        If another run has published since ``base`` was read, this raises and nothing changes.
        """
        tables = dict(base.tables)
        for w in written:
            old = tables.get(w.table)
            if old is not None and (old.schema, old.partition_by) != (w.schema, w.partition_by):
                raise ValueError(f"{w.table} has another schema or other partitions")
            stay = {} if old is None else {p: c for p, c in old.partitions.items() if p not in set((emptied or {}).get(w.table, ()))}
            tables[w.table] = Table(w.schema, w.partition_by, {**stay, **dict.fromkeys(w.partitions, w.commit)})
        said = {n: {"schema": t.schema, "partition_by": t.partition_by, "partitions": t.partitions} for n, t in tables.items()}
        files.write_new_text(self.spark, f"{self.root}/log/{base.number + 1:012d}.json", json.dumps(said))
        return Snapshot(base.number + 1, tables)

    # --- what broken runs and old states leave ------------------------------

    def unfinished(self, snapshots: Collection[Snapshot] | None = None) -> list[str]:
        """Folders no published state points to: those of a run that broke off, or of one still at work."""
        if snapshots is None:
            snapshots = [self.at(int(n[:-5])) for n in files.names(self.spark, f"{self.root}/log") if n.endswith(".json") and not n.startswith(".")]
        known = {f"{name}/commit={c}" for s in snapshots for name, t in s.tables.items() for c in t.partitions.values()}
        return [f for f in files.folders(self.spark, f"{self.root}/data", 2) if f not in known]

    def clean(self, keep: int = 2) -> list[str]:
        """Remove states but the last ``keep``, and folders none of these needs. For the one run that writes; the folders removed."""
        log = [n for n in files.names(self.spark, f"{self.root}/log") if n.endswith(".json") and not n.startswith(".")]
        gone = self.unfinished([self.at(int(n[:-5])) for n in log[-keep:]])
        for name in log[:-keep]:
            files.remove(self.spark, f"{self.root}/log/{name}")
        for folder in gone:
            files.remove(self.spark, f"{self.root}/data/{folder}")
        return gone


def replace_batches(
    books: Snapshots, base: Snapshot, df: DataFrame, table: str, schema: str, closed: DataFrame,
    batch_keys: Sequence[str] = ("brand", "batchid"), partition_by: Sequence[str] = ("brand", "batch_month"),
) -> tuple[Written, list[str]]:
    """Write the partitions in which the ``closed`` batches fall: other batches as they were, closed ones with the rows of ``df``.

    ``closed`` has the batch keys and the partition columns, a row for each batch: as many as days are closed. A batch without new rows
    ends up empty. Returns what to publish, and the partitions that are gone unless written.
    """
    touched = closed.select(*partition_by).distinct().collect()
    folders = [partition_folder(row.asDict()) for row in touched]
    old = books.read(table, schema, base, folders).join(closed.select(*batch_keys).distinct(), list(batch_keys), "left_anti")
    names = [f.name for f in StructType.fromDDL(schema)]
    rows = old.select(*names).unionByName(conform(df, schema).join(closed.select(*batch_keys).distinct(), list(batch_keys), "left_semi").select(*names))
    return books.write(rows, table, schema, partition_by), folders


def merge_partitions(
    books: Snapshots, base: Snapshot, table: str, schema: str, partition_by: Sequence[str], changed: DataFrame, key: Sequence[str],
) -> tuple[Written, list[str]]:
    """Write only the partitions a change touches: old rows whose key does not change, and all changed rows.

    ``changed`` has the table's columns. A row that moves to another partition leaves its old one only if that is touched too, so
    the partition columns must not change with a row's other columns.
    """
    changed = conform(changed, schema)
    touched = [partition_folder(row.asDict()) for row in changed.select(*partition_by).distinct().collect()]
    old = books.read(table, schema, base, touched)
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key]
    condition = same[0]
    for more in same[1:]:
        condition &= more
    kept = old.alias("o").join(changed.select(*key).alias("n"), condition, "left_anti").select(*old.columns)
    return books.write(kept.unionByName(changed.select(*old.columns)), table, schema, partition_by), touched
