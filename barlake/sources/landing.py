"""A sink that lands every document as one named file.

A Python data source (``landed_documents``): a task writes its documents under
hidden names (a leading dot: no listing shows them) and reports both names in
its commit message. When all tasks have committed, the files get their real
names; a task that fails deletes what it wrote, and a job that fails deletes
what its tasks reported, so nothing of either is ever listed. Landing the same
documents again replaces the same files. Storage is reached through pyarrow's
file systems, by URI or path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FORMAT = "landed_documents"
SCHEMA = "value string, file_name string, year string, month string, day string"


def landed_documents_source():
    """The data source class, with all that its tasks need inside: workers take it by value."""
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    @dataclass
    class Landed(WriterCommitMessage):
        names: list  # (hidden, real) paths

    def open_fs(uri):
        from pyarrow import fs
        return fs.FileSystem.from_uri(uri)

    def each(names, work):
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(work, names))

    class NamedFiles(DataSourceWriter):
        def __init__(self, root):
            self.root = root.rstrip("/")

        def write(self, iterator):
            import uuid
            fs, root = open_fs(self.root)
            attempt, names, folders = uuid.uuid4().hex, [], set()
            try:
                for row in iterator:
                    folder = f"{root}/year={row.year}/month={row.month}/day={row.day}"
                    if folder not in folders:
                        fs.create_dir(folder, recursive=True)
                        folders.add(folder)
                    hidden = f"{folder}/.{row.file_name}.{attempt}"
                    names.append((hidden, f"{folder}/{row.file_name}"))
                    with fs.open_output_stream(hidden, compression=None) as out:
                        out.write((row.value or "").encode())
            except BaseException:
                self.remove(fs, names)
                raise
            return Landed(names)

        @staticmethod
        def remove(fs, names):
            def one(name):
                try:
                    fs.delete_file(name[0])
                except OSError:
                    pass  # not written yet
            each(names, one)

        def commit(self, messages):
            fs, _ = open_fs(self.root)
            each([n for m in messages if m is not None for n in m.names], lambda n: fs.move(*n))

        def abort(self, messages):
            fs, _ = open_fs(self.root)
            self.remove(fs, [n for m in messages if m is not None for n in m.names])

    class LandedDocuments(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return SCHEMA

        def writer(self, schema, overwrite):
            if overwrite:
                raise ValueError("documents are added, or replace those of the same name")
            return NamedFiles(self.options["path"])

    return LandedDocuments


def land(docs: DataFrame, root: str) -> None:
    """Write documents (``SCHEMA``) to the files that they name."""
    spark: SparkSession = docs.sparkSession
    spark.dataSource.register(landed_documents_source())
    docs.write.format(FORMAT).mode("append").save(root)
