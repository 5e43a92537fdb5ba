"""Tables of one run that appear together: written aside, listed in a manifest, and moved when it is there."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class RunCommit:
    """Parquet tables of the run run_id, with what is needed to finish or repeat it below folder.

    write() each table to the path that aside() gives, then commit(). The manifest is put in place by one rename; before
    it, nothing of the run is in its tables, and a new try begins with nothing; behind it, a new try only moves what has not been
    moved. So a run repeated under its id, done or not, changes no table twice. Files are moved within one file system.
    """

    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.folder = f"{folder.rstrip('/')}/_runs/{run_id}"
        self.manifest, self.tables = f"{self.folder}/manifest.json", []

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def begin(self) -> bool:
        """True if the tables are to be written; False if an earlier try has, and whatever it left is in place now."""
        system = self._system(self.folder)
        if system.exists(self._path(self.manifest)):
            self._move(json.loads("".join(r["value"] for r in self.spark.read.text(self.manifest).collect())))
            return False
        system.delete(self._path(self.folder), True)
        return True

    def aside(self, table: str) -> str:
        """Where the rows for the table at this path are to be written."""
        self.tables.append((f"{self.folder}/{len(self.tables)}", table))
        return self.tables[-1][0]

    def commit(self) -> None:
        system = self._system(self.folder)
        found = [[own, table, self._files(own)] for own, table in self.tables]
        first = self._path(f"{self.folder}/manifest.tmp")
        out = system.create(first, True)
        out.write(bytearray(json.dumps(found).encode()))
        out.close()
        if not system.rename(first, self._path(self.manifest)):
            raise OSError(f"could not put {self.manifest} in place")
        self._move(found)

    def _files(self, own: str) -> list[str]:
        """Data files below a folder, by their paths from there."""
        system, root = self._system(own), self._path(own)
        if not system.exists(root):
            return []
        every, out, prefix = system.listFiles(root, True), [], system.makeQualified(root).toUri().getPath() + "/"
        while every.hasNext():
            path = every.next().getPath().toUri().getPath().removeprefix(prefix)
            if path.rsplit("/", 1)[-1][:1] not in "._":
                out.append(path)
        return sorted(out)

    def _move(self, found: list) -> None:
        for own, table, files in found:
            system = self._system(table)
            system.mkdirs(self._path(table))
            for name in files:
                source, target = self._path(f"{own}/{name}"), self._path(f"{table}/{name}")
                if not system.exists(source):  # moved by an earlier try
                    continue
                system.mkdirs(target.getParent())
                if not system.rename(source, target):
                    raise OSError(f"could not move {own}/{name} to {table}")
            system.delete(self._path(own), True)
