"""An append-only log of Parquet files as a replayable stream source.

``append`` writes the rows of one append as ``append=N`` below the log's folder; the folder
counts once Spark's commit mark ``_SUCCESS`` stands in it. ``stream`` reads the log with offsets
``{"append": N}`` (the last append read), so the rows between two offsets are the same whenever
they are asked for: a micro-batch that is replayed after a failure reads what it read before.

* Appends are numbered upwards by their producer. An append is offered once no lower one is
  unfinished; writing a number again (a replayed producer) replaces the folder with the same rows.
* Planning lists folders and reads the footers of the appends asked for. A task reads one
  row group of one file, so a batch after a long stop is split like any scan.
* An offset holds nothing but the append's number: files are found by listing, not remembered.
* Empty appends and an empty or missing log are fine and give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "visitlens_append_log"
#: Nothing read yet: appends are numbered from 0.
BEFORE_ALL = -1


def append(rows: DataFrame, path: str, number: int) -> None:
    """Write ``rows`` as append ``number`` (0 or more), replacing it where it was written before."""
    if number < 0:
        raise ValueError("appends are numbered from 0")
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/append={number}")


def _files_of(path: str):
    """(file system, folder) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(Path(path.removeprefix("file:")).absolute().as_uri())


@dataclass
class RowGroup(InputPartition):
    """A row group of a file: what one task reads."""

    file: str
    group: int


class AppendLogReader(DataSourceStreamReader):
    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def _finished(self, after: int) -> list[tuple[int, list[str]]]:
        """(number, files) of the appends above ``after`` that precede the first unfinished one, ascending."""
        from pyarrow import fs

        store, root = _files_of(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        numbered = sorted((int(f.base_name.removeprefix("append=")), f.path) for f in found
                          if f.type == fs.FileType.Directory and f.base_name.startswith("append="))
        out: list[tuple[int, list[str]]] = []
        for number, folder in numbered:
            if number <= after:
                continue
            names = [f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.File]
            if f"{folder}/_SUCCESS" not in names:
                break
            out.append((number, sorted(n for n in names if n.endswith(".parquet"))))
        return out

    def initialOffset(self) -> dict:
        return {"append": BEFORE_ALL}

    def latestOffset(self) -> dict:
        # appends already offered need not be listed again
        self.offered = max([self.offered, *(n for n, _ in self._finished(self.offered))])
        return {"append": self.offered}

    offered = BEFORE_ALL

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        import pyarrow.parquet as pq

        self.offered = max(self.offered, end["append"])
        store, _ = _files_of(self.path)
        wanted = [(n, files) for n, files in self._finished(start["append"]) if n <= end["append"]]
        if end["append"] > start["append"] and (not wanted or wanted[-1][0] != end["append"]):
            raise RuntimeError(f"append {end['append']} of {self.path} was read before and is gone")
        return [RowGroup(name, group) for _, files in wanted for name in files
                for group in range(pq.read_metadata(name, filesystem=store).num_row_groups)]

    def read(self, partition: RowGroup) -> Iterator:
        import pyarrow.parquet as pq

        store, _ = _files_of(self.path)
        with store.open_input_file(partition.file) as f:
            yield from pq.ParquetFile(f).iter_batches(row_groups=[partition.group], columns=self.columns)


class AppendLogSource(DataSource):
    """Options ``path`` (the log's folder) and ``fields`` (the schema's DDL)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return self.options["fields"]

    def streamReader(self, schema) -> AppendLogReader:
        return AppendLogReader(self.options["path"], schema.fieldNames())


def stream(spark: SparkSession, path: str, fields: str = "value string") -> DataFrame:
    """The log at ``path`` as a stream of the columns ``fields`` (other stored columns aren't read)."""
    sc = spark.sparkContext
    if sc.master.startswith("local") and "PYTHONPATH" not in sc.environment:  # on a cluster the package is installed
        sc.environment["PYTHONPATH"] = str(Path(__file__).parents[2])
    spark.dataSource.register(AppendLogSource)
    return spark.readStream.format(FORMAT).option("path", path).option("fields", fields).load()
