"""K1/K2 — a panel's pages replaced at one moment, readable while they are written.

A refresh writes every table of a panel into a new version folder,

    <root>/<table>/panel=<panel>/version=<version>/question_num=<n>/…

which nobody reads yet.  When the last one is complete, a numbered manifest that names the
panel's new folders (and every other panel's as before) is written under a name of its own
and renamed to the next number, which fails if another refresh took that number: then the
newer manifest is read again and the panel put into it.  Readers take the manifest with the highest
number, so they see all of a panel's old pages or all of its new ones; a refresh that dies
halfway leaves an unnamed folder behind and nothing else.

The folders of the last manifests stay, so that readers who have already resolved one can
go on; ``vacuum`` deletes older ones, and what dead refreshes left once it is old enough.
Only Hadoop's file system interface is used, so any store that Spark writes to will do.
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"
KEEP = 2            # manifests whose folders stay
ORPHAN_HOURS = 24   # what no manifest names is left alone for so long: it may be being written
ATTEMPTS = 50


class Published:
    """The published tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    # ------------------------------------------------------------ manifests
    def _numbers(self) -> list[int]:
        where = self._path(MANIFESTS)
        if not self._fs.exists(where):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(where)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def _load(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{MANIFESTS}/{number:012d}.json"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def manifest(self) -> dict:
        """``{"number": n, "tables": {table: {panel: {"folder", "schema"}}}}`` as published last."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else {"number": 0, "tables": {}}

    def _claim(self, manifest: dict) -> bool:
        """Publish under the manifest's number, unless that is taken."""
        made, final = self._path(f"{MANIFESTS}/.{uuid.uuid4().hex}"), self._path(f"{MANIFESTS}/{manifest['number']:012d}.json")
        out = self._fs.create(made, False)
        try:
            out.write(json.dumps(manifest).encode())
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(made, final, none)  # never over an existing file
            return True
        except Py4JJavaError as e:
            self._fs.delete(made, False)
            if self._fs.exists(final):
                return False
            raise e

    def publish(self, changes: dict[str, dict[str, dict]], expected: int | None = None) -> int | None:
        """Put these panels' tables in place of all that they had, and return the manifest's number.

        With ``expected``, only as the manifest after that one: None if there is another by now."""
        for _ in range(ATTEMPTS):
            now = self.manifest()
            if expected is not None and now["number"] != expected:
                return None
            kept = {t: {p: v for p, v in panels.items() if p not in changes} for t, panels in now["tables"].items()}
            for panel, tables in changes.items():
                for t, entry in tables.items():
                    kept.setdefault(t, {})[panel] = entry
            if self._claim({"number": now["number"] + 1, "tables": {t: p for t, p in kept.items() if p}}):
                return now["number"] + 1
        raise RuntimeError(f"{self.root}: {ATTEMPTS} other refreshes were published at the same time")

    # ------------------------------------------------------------ writing
    @contextlib.contextmanager
    def refresh(self, panel: str) -> Iterator[Refresh]:
        """Tables written inside the block become the panel's pages together when it ends well;
        tables of the panel that it doesn't write are withdrawn."""
        new = Refresh(self, panel)
        yield new
        self.publish({panel: new.tables})

    # ------------------------------------------------------------ reading
    def panels(self, table: str) -> list[str]:
        return sorted(self.manifest()["tables"].get(table, {}))

    def _read(self, entry: dict) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{entry['folder']}").parquet(f"{self.root}/{entry['folder']}")

    def table(self, table: str, panel: str | None = None) -> DataFrame:
        """A published table with its column ``panel``, of one panel or of all."""
        entries = self.manifest()["tables"].get(table, {})
        wanted = sorted(entries) if panel is None else [panel]
        if not entries or any(p not in entries for p in wanted):
            raise LookupError(f"{self.root}: no table {table!r} is published" + (f" for panel {panel!r}" if panel else ""))
        parts = [self._read(entries[p]).withColumn("panel", F.lit(p)) for p in wanted]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def page(self, table: str, panel: str, number: int) -> DataFrame:
        """The rows of one page: only its folder is read."""
        return self.table(table, panel).where(F.col("question_num") == number)

    # ------------------------------------------------------------ cleaning
    def vacuum(self, keep: int = KEEP, orphan_hours: float = ORPHAN_HOURS) -> list[str]:
        """Delete manifests but the last ``keep`` and the folders only they name, and unnamed
        folders older than ``orphan_hours``; returns the folders."""
        numbers = self._numbers()
        if not numbers or keep < 1:
            return []
        folders = lambda ns: {e["folder"] for n in ns for t in self._load(n)["tables"].values() for e in t.values()}
        stay, old = folders(numbers[-keep:]), folders(numbers[:-keep])
        gone, before = [], (time.time() - orphan_hours * 3600) * 1000
        for status in self._fs.globStatus(self._path("*/panel=*/version=*")) or []:
            name = "/".join(status.getPath().toString().rsplit("/", 3)[1:])
            if name not in stay and (name in old or status.getModificationTime() < before):
                self._fs.delete(status.getPath(), True)
                gone.append(name)
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{MANIFESTS}/{n:012d}.json"), False)
        return sorted(gone)


class Refresh:
    """The version of one panel that is being written."""

    def __init__(self, target: Published, panel: str):
        if "/" in panel or not panel:
            raise ValueError(f"{panel!r} can't be a folder's name")
        self.target, self.panel = target, panel
        self.version = f"{time.strftime('%Y%m%d%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, dict] = {}

    def write(self, table: str, df: DataFrame) -> None:
        """Write the panel's rows of ``df`` (all, if it has no column ``panel``): partitioned by
        ``question_num`` if there is one, a hot question over several writers."""
        if table in self.tables:
            raise ValueError(f"{table!r} is already written in this refresh")
        if "panel" in df.columns:
            df = df.where(F.col("panel") == self.panel).drop("panel")
        folder = f"{table}/panel={self.panel}/version={self.version}"
        rows = df.hint("rebalance", "question_num") if "question_num" in df.columns else df
        writer = rows.write.mode("error")
        if "question_num" in df.columns:
            writer = writer.partitionBy("question_num")
        writer.parquet(f"{self.target.root}/{folder}")
        columns = [c for c in df.columns if c != "question_num"] + ["question_num"] * ("question_num" in df.columns)
        self.tables[table] = {"folder": folder, "schema": df.select(*[F.col(f"`{c}`") for c in columns]).schema.jsonValue()}

    def read(self, table: str) -> DataFrame:
        """A table written in this refresh, before it is published."""
        return self.target._read(self.tables[table])
