"""Where quarantined documents go: any Spark data source, chosen by name.

``parquet``, ``json``, ``jdbc`` and the like are there already. A sink of one's own
is a Python data source with a writer, registered under its name; reports as text
files, for people to read, are the one that comes with the library.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from treeseek.operators.validity import counted

REPORTS = "error_reports"


def store(errors: DataFrame, sink: str, options: Mapping[str, str] | None = None) -> int:
    """Add the errors to a sink; how many there are is counted while they are written."""
    if sink == REPORTS:
        errors.sparkSession.dataSource.register(ErrorReports)
    seen = Observation()
    counted(errors, seen).write.format(sink).options(**(options or {})).mode("append").save()
    return seen.get["errors"]


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


class ErrorReports(DataSource):
    """One text file per task: for each error its reference, then what is wrong and with what.

    Files get their final names when all tasks have ended, so a task that runs
    twice or a job that fails leaves no reports. Option ``path``: a folder that
    all executors reach.
    """

    @classmethod
    def name(cls) -> str:
        return REPORTS

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if "path" not in self.options:
            raise ValueError(f"{REPORTS}: option path is missing")
        return _ReportWriter(self.options["path"].rstrip("/"))


class _ReportWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def _files(self):
        from pyarrow.fs import FileSystem

        return FileSystem.from_uri(self.folder)

    def write(self, rows: Iterator) -> _Written:
        first = next(rows, None)
        if first is None:
            return _Written(None)
        files, folder = self._files()
        files.create_dir(f"{folder}/_pending")
        name = f"{uuid.uuid4().hex}.txt"
        with files.open_output_stream(f"{folder}/_pending/{name}") as out:
            row = first
            while row is not None:
                # Each on a line of its own, whatever line ends the document holds.
                fields = (row["reference"], row["reason"], row["doc_id"], json.dumps(row["payload"]))
                out.write(("\t".join("" if f is None else str(f) for f in fields) + "\n").encode())
                row = next(rows, None)
        return _Written(name)

    def commit(self, messages: list) -> None:
        files, folder = self._files()
        for message in messages:
            if message is not None and message.name is not None:
                files.move(f"{folder}/_pending/{message.name}", f"{folder}/{message.name}")

    def abort(self, messages: list) -> None:
        files, folder = self._files()
        for message in messages:
            if message is not None and message.name is not None:
                files.delete_file(f"{folder}/_pending/{message.name}")
