"""Tables that change: snapshots of Parquet below one folder, with a pointer to the current one, and recorded migrations.

Parquet takes no updates. A change writes the next snapshot and then moves the pointer, so that readers see the old table or the
new one; a run that dies in between leaves the pointer where it was. One driver writes.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .shared import delete

#: The columns of the tables, as far as any operator reads or writes them.
TABLES = {
    "casts": (
        "id bigint, hash binary, parent_hash binary, root_hash binary, fid bigint, text string, embeds string, urls array<string>, quotes array<binary>, "
        "mentions array<bigint>, positions array<int>, ts timestamp, threads_status smallint, media_status smallint, embedding384 array<tinyint>, claimed_at timestamp"
    ),
    "reactions": "fid bigint, target_hash binary, reaction_type smallint",
    "profiles": "fid bigint, username string",
    "user_labels": "target_fid bigint, label_type string, label_value string",
    "threads": (
        "hash binary, author_fid bigint, ts timestamp, spam smallint, thread_status smallint, blob string, fids array<bigint>, reactions bigint, tokens int, "
        "blob_ts timestamp, blob_embedding array<float>, blob_embedding_binary binary, canonical_hash binary, thread_type string, value_exchange string, "
        "interaction_pattern string, classified_at timestamp"
    ),
    "media": "url string, summary string, media_type string, media_status smallint, claimed_at timestamp",
    "catalog": "frames_url string, title string, description string, tags array<string>, raw_data string, last_updated timestamp",
}


class Store:
    """Named tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read_json(self, *parts: str):
        fs, path = self._files(), self._path(*parts)
        if not fs.exists(path):
            return None
        with_ = fs.open(path)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(with_)))
        finally:
            with_.close()

    def _write_json(self, value, *parts: str) -> None:
        """Under another name first: the file is the old one or the new one."""
        fs, path, tmp = self._files(), self._path(*parts), self._path(*parts[:-1], parts[-1] + ".new")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        if fs.exists(path):
            fs.delete(path, False)
        fs.rename(tmp, path)

    def version(self, name: str) -> int | None:
        now = self._read_json(name, "current.json") or self._read_json(name, "current.json.new")
        return now["version"] if now else None

    def exists(self, name: str) -> bool:
        return self.version(name) is not None

    def create(self, name: str, schema: str | None = None) -> None:
        """An empty table, unless there is one."""
        if not self.exists(name):
            self.put(name, self.spark.createDataFrame([], schema or TABLES[name]))

    def get(self, name: str) -> DataFrame:
        version = self.version(name)
        if version is None:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}/v{version}")

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """The next snapshot; the one before the last goes, so that a reader of the last is not disturbed."""
        last = self.version(name)
        new = 0 if last is None else last + 1
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}/v{new}")
        self._write_json({"version": new}, name, "current.json")
        if new > 1:
            delete(self.spark, f"{self.folder}/{name}/v{new - 2}")
        return self.get(name)

    def migrate(self, steps: list[tuple[str, Callable[[Store], None]]], module: str | None = None, as_of: str | None = None) -> list[str]:
        """Runs the named steps that were never run, in order, and records each as it ends; returns their names."""
        done = self._read_json("migrations.json") or []
        names, ran = {m["filename"] for m in done}, []
        for name, step in steps:
            if name not in names:
                step(self)
                done.append({"id": len(done) + 1, "filename": name, "module": module, "applied_at": as_of})
                self._write_json(done, "migrations.json")
                ran.append(name)
        return ran

    def migrations(self) -> list[dict]:
        return self._read_json("migrations.json") or []


#: The tables as migrations, in order of their names.
BOOTSTRAP = [(f"{i:03d}_{name}", lambda store, name=name: store.create(name)) for i, name in enumerate(TABLES)]


class View:
    """A stored result: computed when first asked for, and again on refresh."""

    def __init__(self, store: Store, name: str, compute: Callable[[], DataFrame]):
        self.store, self.name, self.compute = store, name, compute

    def get(self) -> DataFrame:
        return self.store.get(self.name) if self.store.exists(self.name) else self.refresh()

    def refresh(self) -> DataFrame:
        return self.store.put(self.name, self.compute())
