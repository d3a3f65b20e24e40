"""Final tables: partitioned Parquet tables of Spark, with commits that count as a whole or not at all.

The rows of a table lie below ``data``, partitioned by ``_part``, a hash of ``spec.distribute_by``. A load writes the parts
that it changes to a folder of its own. Renaming its commit file is the commit: of two loads that started from the same
version the second one fails there. Then Spark replaces those partitions by dynamic partition overwrite; the others are not
touched. A job that dies before the rename changes nothing. One that dies after it has committed: readers take the changed
parts from its folder, and the next load moves them before it commits itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cambio.schemas import TableSpec

PART = "_part"


class CommittedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: TableSpec,
        parts: int = 1,
        stored_as: TableSpec | None = None,
        view: Callable[[DataFrame], DataFrame] | None = None,
    ):
        """``parts`` is fixed by the first commit. ``view`` makes the rows of ``spec`` of those that are stored."""
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.stored_as, self._view = stored_as or spec, view or (lambda rows: rows)
        self._new_parts = parts if spec.distribute_by else 1

    # reading

    def read(self) -> DataFrame:
        """The table as last committed. It is overwritten in place: a reader that outlasts a load has to read again."""
        return self._view(self.stored())

    def stored(self) -> DataFrame:
        """The rows in the columns they are stored in."""
        return self._all_parts().select(*self.stored_as.columns)

    def touched_by(self, keys: DataFrame) -> DataFrame:
        """Stored rows of the parts that rows with the distribution columns fall into.

        The different parts, as many as the table has at most, are broadcast, and prune the scan while it runs.
        """
        # the condition always holds; dynamic pruning is only planned for a side that a filter may have made small
        parts = keys.select(self.part_of().alias(PART)).distinct().where(F.col(PART) >= 0)
        return self._all_parts().join(F.broadcast(parts), PART, "left_semi").select(*self.stored_as.columns)

    def part_of_key(self, *values: Column) -> DataFrame:
        """The rows of the one part that a literal distribution key belongs to: its folder alone is listed and read."""
        part = F.pmod(F.hash(*values), F.lit(self.parts)) if self.parts > 1 else F.lit(0)
        return self._view(self._all_parts().where(F.col(PART) == part).select(*self.stored_as.columns))

    @property
    def version(self) -> int:
        """Number of commits so far."""
        folder, fs = self._hadoop_path("_commits"), self._file_system()
        names = [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []
        return max((int(name.removesuffix(".json")) for name in names if name[:1].isdigit()), default=0)

    @property
    def parts(self) -> int:
        return self._commit(self.version).get("parts", self._new_parts)

    def part_of(self) -> Column:
        """The part a row belongs to; an expression over the distribution columns."""
        total = self.parts
        return F.lit(0) if total == 1 else F.pmod(F.hash(*self.spec.distribute_by), F.lit(total))

    def has_batch(self, stream: str, batch_id: int) -> bool:
        """Whether this batch of this stream was committed before (a stream may deliver a batch twice)."""
        return self._commit(self.version)["streams"].get(stream, -1) >= batch_id

    # writing

    def commit(self, rows: DataFrame | None, batch: tuple[str, int] | None = None, base: int | None = None) -> int:
        """Replace the parts that the stored ``rows`` belong to; returns the new version. Without rows nothing is replaced.

        ``rows`` have to be all rows of their parts, and may be computed from the table. ``base`` is the version that they
        were computed from (default: the newest now). ``batch`` is a (stream, batch id) remembered for :meth:`has_batch`.
        """
        self._settle()
        base = self.version if base is None else base
        before = self._commit(base)
        total, folder = before.get("parts", self._new_parts), None
        if rows is not None:
            folder = f"_new-{uuid.uuid4().hex}"
            part = F.lit(0) if total == 1 else F.pmod(F.hash(*self.spec.distribute_by), F.lit(total))
            self._ordered(rows.withColumn(PART, part)).partitionBy(PART).parquet(f"{self.path}/{folder}")
        streams = {**before["streams"], **({batch[0]: batch[1]} if batch else {})}
        self._publish(base + 1, {"parts": total, "streams": streams, "pending": folder})
        self._settle()
        return base + 1

    def _settle(self) -> None:
        """Move the parts of the last commit to their place. Doing so twice, or after half of it, gives the same."""
        pending = self._pending()
        if pending:
            rows = self._below(pending)
            self._ordered(rows, mode="overwrite", partitionOverwriteMode="dynamic").partitionBy(PART).parquet(
                f"{self.path}/data"
            )
            self._file_system().delete(self._hadoop_path(pending), True)

    def _ordered(self, rows: DataFrame, mode: str = "errorifexists", **options: str):
        """A writer of rows that stay in their task and are sorted there."""
        return rows.sortWithinPartitions(PART, *self.stored_as.sort_by).write.mode(mode).options(**options)

    # files

    def _all_parts(self) -> DataFrame:
        pending = self._pending()
        if not pending:
            return self._below("data")
        changed = [int(name.split("=")[1]) for name in self._names(pending) if name.startswith(f"{PART}=")]
        return self._below("data").where(~F.col(PART).isin(changed)).unionByName(self._below(pending))

    def _below(self, folder: str) -> DataFrame:
        schema = T.StructType([*self.stored_as.schema.fields, T.StructField(PART, T.IntegerType())])
        if not any(name.startswith(f"{PART}=") for name in self._names(folder)):
            # a relation that the optimizer knows to be empty: the first merge then needs no join
            nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
            return self.spark.range(1).select(*nothing).where(F.lit(False))
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")

    def _pending(self) -> str | None:
        """The folder of the last commit, as long as its parts have not all been moved."""
        folder = self._commit(self.version).get("pending")
        return folder if folder and self._file_system().exists(self._hadoop_path(folder)) else None

    def _names(self, folder: str) -> list[str]:
        fs, path = self._file_system(), self._hadoop_path(folder)
        return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []

    def _commit(self, version: int) -> dict:
        if version == 0:
            return {"streams": {}}
        stream = self._file_system().open(self._hadoop_path(f"_commits/{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, version: int, content: dict) -> None:
        draft = self._hadoop_path(f"_commits/_draft-{uuid.uuid4().hex}")
        out = self._file_system().create(draft, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(draft, self._hadoop_path(f"_commits/{version:012d}.json"), no_overwrite)

    def _hadoop_path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _file_system(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
