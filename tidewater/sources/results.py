"""Result tables that are computed once, kept in the shared folder and replaced as a whole.

A result has a folder of its own with one subfolder per version and a small file ``CURRENT`` that
names the version in force, its schema and what it was made from.  A new version is written in full
beside the old one and comes into force by one rename, so a reader sees the old table or the new one,
and a write that fails in the middle changes nothing.  All files are reached through Hadoop's file
system interface, so the folder may lie in any store that the cluster reads.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CURRENT = "CURRENT"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.  A local session without one, as
    in tests, gets a temporary folder; a cluster without one is an error, since its machines have no
    folder in common that this library could choose."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidewater-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def has_shared_folder(spark: SparkSession) -> bool:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is not None


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> dict[str, list]:
    """For each of ``paths`` its number of data files, their bytes, and a digest of their names, lengths and
    times of change, by one listing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = {}
    for path in paths:
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            raise FileNotFoundError(path)
        files, listed = [], fs.listFiles(root, True)
        while listed.hasNext():
            f = listed.next()
            name = f.getPath().getName()
            if not name.startswith(("_", ".")):
                files.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
        listing = json.dumps(sorted(files)).encode()
        found[path] = [len(files), sum(f[1] for f in files), hashlib.sha256(listing).hexdigest()]
    return found


def plan_digest(df: DataFrame) -> str:
    """What ``df`` computes, as a short text: equal plans have equal digests in any session."""
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    return hashlib.sha256(plan.encode()).hexdigest()[:16]


class ResultStore:
    """Named result tables below one shared folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = (folder or f"{shared_folder(spark)}/results").rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    @staticmethod
    def _checked(name: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
            raise ValueError(f"not a name for a result table: {name!r}")
        return name

    def _manifest(self, name: str) -> dict | None:
        path = self._path(self._checked(name), CURRENT)
        if not self._fs().exists(path):
            return None
        lines = self.spark.read.option("wholetext", True).text(path.toString()).collect()  # one small file
        return json.loads(lines[0].value)

    def _publish(self, name: str, manifest: dict) -> None:
        """Put the manifest in force: a file beside it, then one rename over the old one."""
        fs, beside = self._fs(), self._path(name, f".{CURRENT}-{uuid.uuid4().hex}")
        out = fs.create(beside, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        over = self.spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), self._conf).rename(beside, self._path(name, CURRENT), over)

    def exists(self, name: str) -> bool:
        return self._manifest(name) is not None

    def is_fresh(self, name: str, inputs: Sequence[str], variant: str = "") -> bool:
        """Whether a version is in force that was made from the files that ``inputs`` hold now."""
        m = self._manifest(name)
        return m is not None and m["variant"] == variant and m["inputs"] == fingerprint(self.spark, inputs)

    def read(self, name: str) -> DataFrame:
        m = self._manifest(name)
        if m is None:
            raise KeyError(f"no result table {name!r}")
        return self.spark.read.schema(T.StructType.fromJson(m["schema"])).parquet(self._path(name, m["version"]).toString())

    def replace(self, name: str, df: DataFrame, inputs: Sequence[str] = (), variant: str = "", keep: int = 2) -> DataFrame:
        """Write ``df`` as the new version of ``name`` and read it back with its own types.

        Versions other than the last ``keep`` are dropped, so that readers of the one just replaced can
        finish.  ``inputs`` are listed before the write: a file that changes meanwhile makes the
        result stale, never falsely fresh.
        """
        self._checked(name)
        before, old = fingerprint(self.spark, inputs), self._manifest(name)
        version = f"v{(old['number'] if old else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(self._path(name, version).toString())
        self._publish(name, {"version": version, "number": (old["number"] if old else 0) + 1, "variant": variant, "inputs": before,
                             "schema": json.loads(df.schema.json())})
        fs = self._fs()
        versions = sorted(s.getPath().getName() for s in fs.listStatus(self._path(name)) if s.isDirectory())
        for gone in versions[:-keep]:
            fs.delete(self._path(name, gone), True)
        return self.read(name)

    def materialise(self, name: str, make: Callable[[], DataFrame], inputs: Sequence[str], variant: str = "") -> DataFrame:
        """The result ``name``, computed by ``make`` only if it is missing or stale.  ``variant`` tells results
        of one name with other parameters apart."""
        if self.is_fresh(name, inputs, variant):
            return self.read(name)
        return self.replace(name, make(), inputs, variant)

    def drop(self, name: str, if_exists: bool = True) -> None:
        fs, path = self._fs(), self._path(self._checked(name))
        if not fs.exists(path):
            if if_exists:
                return
            raise KeyError(f"no result table {name!r}")
        fs.delete(path, True)

    def names(self) -> list[str]:
        fs = self._fs()
        if not fs.exists(self._path()):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(self._path()) if self.exists(s.getPath().getName()))


def scratch(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh table in the shared folder and read back, for jobs of several rounds."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
