"""Posts and state of many runs with one commit for both.

Below ``base`` every try of a run writes folders of its own, ``posts/attempt=<id>`` and
``state/attempt=<id>``, and then one small file, ``manifest/<version>.json``, that names the
folders which count. That file appears by a rename, so a reader sees a run whole or not at all:
posts of a run that died are in no manifest. A repeated run is named in place of its former try.
Two writers that begin with one version cannot both end: the second finds its version taken.

The manifest has an entry per run, or one per compaction; it is read by the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.session import path_exists
from digestloom.sources import posts as post_source, state as state_source

TABLES = ("posts", "state")
COMPACTED = "compacted"


class Conflict(RuntimeError):
    """Another writer has committed since this one began."""


@dataclass(frozen=True)
class Version:
    """What counts: for each table, the try of each run."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=lambda: {t: {} for t in TABLES})


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _listed(self, folder: str) -> list[str]:
        if not path_exists(self.spark, folder):
            return []
        fs, path = self._fs(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path))

    def version(self) -> Version:
        """The last version that was committed."""
        names = [n for n in self._listed(f"{self.base}/manifest") if n.endswith(".json") and n[:-5].isdigit()]
        if not names:
            return Version()
        fs, path = self._fs(f"{self.base}/manifest/{names[-1]}")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        return Version(int(names[-1][:-5]), json.loads(bytes(text).decode()))

    def commit(self, began: Version, changes: dict[str, dict[str, str | None]]) -> Version:
        """Write the next version: ``began`` with the tries of ``changes``; None takes a run out."""
        tables = {t: dict(began.tables.get(t, {})) for t in TABLES}
        for table, tries in changes.items():
            for run, attempt in tries.items():
                tables[table].pop(run, None)
                if attempt is not None:
                    tables[table][run] = attempt
        number = began.number + 1
        jvm, final = self.spark._jvm, f"{self.base}/manifest/{number:012d}.json"
        fs, draft = self._fs(f"{self.base}/manifest/.{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(draft, jvm.org.apache.hadoop.fs.Path(final), no_overwrite)
        except Exception as error:
            fs.delete(draft, False)
            if path_exists(self.spark, final):
                raise Conflict(f"version {number} was committed by another writer") from error
            raise
        return Version(number, tables)

    def folder(self, table: str, attempt: str) -> str:
        return f"{self.base}/{table}/attempt={attempt}"

    def _read(self, table: str, schema: str, version: Version | None) -> DataFrame:
        tries = (version or self.version()).tables[table]
        if not tries:
            return self.spark.createDataFrame([], schema)
        folders = [self.folder(table, a) for a in sorted(set(tries.values()))]
        # Hidden folders of tries that died are not listed, so nothing looks into them.
        return self.spark.read.schema(f"{schema}, attempt STRING").option("basePath", f"{self.base}/{table}").parquet(*folders).drop("attempt")

    def posts(self, version: Version | None = None) -> DataFrame:
        return self._read("posts", post_source.POST_SCHEMA, version)

    def state(self, except_run: str | None = None, ids: DataFrame | None = None, version: Version | None = None) -> DataFrame:
        """Processed ids of all committed runs but ``except_run``; with ``ids`` only of their days."""
        table = self._read("state", state_source.STORED_SCHEMA, version)
        if except_run is not None:
            table = table.filter(F.col("run_id") != except_run)
        return state_source.of_days(table, ids).select("article_id", "processed_at")

    def write_run(self, posts: DataFrame, run_id: str, as_of: datetime | str, began: Version) -> Version:
        """Write the posts of a run and their ids, then commit both; a run without posts changes nothing."""
        attempt = uuid.uuid4().hex
        post_source.write_posts(posts, self.folder("posts", attempt), run_id)
        written = self.spark.read.schema(post_source.POST_SCHEMA).parquet(self.folder("posts", attempt))
        if written.isEmpty():
            return began
        state_source.append_state(written, self.folder("state", attempt), run_id, as_of)
        return self.commit(began, {t: {run_id: attempt} for t in TABLES})

    def compact_state(self) -> Version:
        """Write the state of all runs as one folder; readers change over with the commit."""
        began, attempt = self.version(), uuid.uuid4().hex
        runs = began.tables["state"]
        if runs:
            state_source.write_compacted(self.state(version=began), f"{self.folder('state', attempt)}/run_id={COMPACTED}")
            return self.commit(began, {"state": {**dict.fromkeys(runs), COMPACTED: attempt}})
        return began

    def remove_unused(self) -> int:
        """Remove the folders of tries that do not count. Not while a run is under way."""
        tables, removed = self.version().tables, 0
        for table in TABLES:
            for name in self._listed(f"{self.base}/{table}"):
                if name.startswith("attempt=") and name.removeprefix("attempt=") not in tables[table].values():
                    fs, path = self._fs(f"{self.base}/{table}/{name}")
                    fs.delete(path, True)
                    removed += 1
        return removed
