"""Tables of Parquet files in partitions: versions, appends and incremental merges.

A table is a folder with one manifest for each version, which names the folders of files of every
partition (a month of the table's date column, or one partition for all rows). A change writes new
folders aside and then a new manifest: partitions it does not touch keep their files, no plan
overwrites what it reads, and a reader sees one version or the next. Folders that the last ``KEPT``
manifests don't name are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Versions whose files stay, for readers that have planned but not yet read.
KEPT = 2
_PART = "_part"
_ALL = "all"


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-10: rows of the batch replace those with equal keys and are added otherwise.

    A null key equals nothing. Columns of either side stay; the other side's rows have null there.
    """
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


class Table:
    """SNK-12: Parquet files by month of ``by``, in order of ``cluster`` within a file."""

    def __init__(self, spark: SparkSession, path: str, by: str | None = None, cluster: Iterable[str] = ()):
        self.spark, self.path, self.by, self.cluster = spark, path.rstrip("/"), by, tuple(cluster)

    # -- files

    def _at(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _fs(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str = "") -> list[str]:
        fs, at = self._fs(), self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def versions(self) -> list[int]:
        return sorted(int(n[9:-5]) for n in self._names() if n.startswith("manifest.") and n.endswith(".json"))

    def version(self) -> int:
        """The latest version, 0 where there is none."""
        return max(self.versions(), default=0)

    def _manifest(self, version: int) -> dict:
        stream = self._fs().open(self._at(f"manifest.{version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def parts(self) -> dict[str, list[str]]:
        """Partition -> its folders of files, under the table's path."""
        version = self.version()
        return self._manifest(version)["parts"] if version else {}

    # -- reading

    def schema(self) -> StructType | None:
        version = self.version()
        return StructType.fromJson(self._manifest(version)["schema"]) if version else None

    def read(self, parts: Iterable[str] | None = None, since=None) -> DataFrame:
        """The rows; of some partitions only, or of those that may hold dates from ``since`` on."""
        manifest = self._manifest(self.version())
        wanted = None if parts is None else set(parts)
        folders = [
            folder
            for part, of in sorted(manifest["parts"].items())
            if (wanted is None or part in wanted) and (since is None or part == _ALL or part >= f"{since:%Y-%m}")
            for folder in of
        ]
        schema = StructType.fromJson(manifest["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def part_of(self, by: Column | None = None) -> Column:
        """The partition of a row; a null date has one of its own, which sorts after all months."""
        if self.by is None:
            return F.lit(_ALL)
        return F.coalesce(F.date_format(F.col(self.by) if by is None else by, "yyyy-MM"), F.lit("none"))

    def parts_in(self, rows: DataFrame) -> list[str]:
        """The partitions that rows fall into: a name for each month."""
        return sorted(r[0] for r in rows.select(self.part_of().alias(_PART)).distinct().collect())

    # -- writing

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Files of the rows in a new folder: partition -> folder."""
        folder = f"data/{uuid.uuid4().hex}"
        sized = rows.withColumn(_PART, self.part_of())
        if self.by is not None:  # large months are split into several files, small ones make one each
            sized = sized.hint("rebalance", F.col(_PART))
            sized = sized.sortWithinPartitions(_PART, *[c for c in (*self.cluster, self.by) if c in rows.columns])
        sized.write.partitionBy(_PART).parquet(f"{self.path}/{folder}")
        made = [n for n in self._names(folder) if n.startswith(f"{_PART}=")]
        return {n.partition("=")[2]: f"{folder}/{n}" for n in made}

    def _commit(self, parts: dict[str, list[str]], schema: StructType) -> None:
        version = self.version() + 1
        text = json.dumps({"parts": parts, "schema": schema.jsonValue()}).encode()
        aside, fs = self._at(f".manifest-{uuid.uuid4().hex}"), self._fs()
        out = fs.create(aside)
        out.write(bytearray(text))
        out.close()
        if not fs.rename(aside, self._at(f"manifest.{version}.json")):
            fs.delete(aside, False)
            raise RuntimeError(f"version {version} of {self.path} was written by another")
        self._clean(version)

    def _clean(self, version: int) -> None:
        """Remove the versions that are no longer kept, and the files that only they name."""
        old = [v for v in self.versions() if v <= version - KEPT]
        names = lambda versions: {f for v in versions for of in self._manifest(v)["parts"].values() for f in of}
        stay, gone = names(range(max(1, version - KEPT + 1), version + 1)), names(old)
        load = lambda folders: {f.rpartition("/")[0] for f in folders}
        whole = load(gone) - load(stay)
        fs = self._fs()
        for folder in whole | {f for f in gone - stay if f.rpartition("/")[0] not in whole}:
            fs.delete(self._at(folder), True)
        for v in old:
            fs.delete(self._at(f"manifest.{v}.json"), False)

    def create(self, schema: StructType) -> None:
        """An empty table (SNK-1); nothing but a manifest is written."""
        self._commit({}, schema)

    def replace(self, rows: DataFrame) -> None:
        """The whole table (SNK-9)."""
        self._commit({p: [f] for p, f in self._write(rows).items()}, rows.schema)

    def append(self, rows: DataFrame) -> None:
        """More files; none of the table's is read or written (SNK-2, SNK-3, SNK-6..8)."""
        self.change({}, rows)

    def change(self, rewritten: dict[str, DataFrame] | None, added: DataFrame | None, touched: list[str] = ()) -> None:
        """One new version: ``touched`` partitions get the rows of ``rewritten``, and ``added`` adds files."""
        parts = {p: list(of) for p, of in self.parts().items()}
        schema = self.schema()
        if rewritten:
            for p in touched:
                parts.pop(p, None)
            for p, f in self._write(rewritten["rows"]).items():
                parts.setdefault(p, []).append(f)
            schema = rewritten["rows"].schema
        if added is not None:
            for p, f in self._write(added).items():
                parts.setdefault(p, []).append(f)
            schema = schema or added.schema
        self._commit(parts, schema)

    def merge(self, batch: DataFrame, keys: list[str]) -> None:
        """SNK-10: upsert. Only partitions that the batch falls into are read and written."""
        if not self.version():
            return self.replace(batch)
        if self.by is not None and self.by not in keys:
            raise ValueError(f"the keys of {self.path} must hold {self.by}, which parts it")
        touched = self.parts_in(batch)
        state = merge_upsert(self.read(touched), batch, keys)
        known = self.schema()
        columns = [*known.names, *[c for c in state.columns if c not in known.names]]
        for c in known.names:
            if c not in state.columns:
                state = state.withColumn(c, F.lit(None).cast(known[c].dataType))
        self.change({"rows": state.select(*columns)}, None, touched)


def with_buffer(df: DataFrame, by: str, order: str, written: int, lookback: int, not_before=None) -> DataFrame:
    """FLT-4 sized in rows: the last ``written`` rows of each entity and the ``lookback`` before them.

    ``_write`` marks the rows to write. Rows before the date ``not_before`` are not read at all, for a
    series dense enough to have as many rows since then.
    """
    rows = df if not_before is None else df.filter(F.col(order) >= F.lit(not_before))
    from_end = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(order)))
    marked = rows.withColumn("_from_end", from_end).filter(F.col("_from_end") <= written + lookback)
    return marked.withColumn("_write", F.col("_from_end") <= written).drop("_from_end")
