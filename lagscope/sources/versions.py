"""Many stored tables published as one version.

A version is a small manifest that names the folders of all its tables. Folders are written
first and never changed; the manifest then appears under the next number, or not at all when
another writer took that number. A reader takes one manifest and reads only what it names, so
it never sees tables of two refreshes side by side. Later versions may name folders of earlier
ones: what did not change is not written again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError

MANIFESTS = "_versions"


class Conflict(RuntimeError):
    """Another writer published a version since the one this refresh began with."""


@dataclass(frozen=True)
class Version:
    """``tables`` maps a table to its schema (as JSON) and its folders by part."""

    number: int = 0
    tables: Mapping[str, dict] = field(default_factory=dict)

    def folders(self, table: str) -> dict[str, str]:
        return dict(self.tables[table]["folders"])

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(self.tables[table]["schema"])
        folders = sorted(self.folders(table).values())
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


class Versions:
    """The versions under one folder, which all writers and readers share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        """What lies in a folder; nothing where there is none."""
        path = self._hadoop.Path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        found = (re.fullmatch(r"(\d{12})\.json", name) for name in self.names(f"{self.root}/{MANIFESTS}"))
        return [int(m[1]) for m in found if m]

    def read(self, number: int) -> Version:
        stream = self._fs.open(self._path(f"{MANIFESTS}/{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(number, json.loads(text))

    def latest(self) -> Version:
        numbers = self.numbers()
        return self.read(numbers[-1]) if numbers else Version()

    def new_folder(self) -> str:
        return f"{self.root}/{uuid.uuid4().hex}"

    def commit(self, base: Version, tables: Mapping[str, dict]) -> Version:
        """Publish ``tables`` as the version after ``base``; ``Conflict`` where that exists.

        The manifest is written whole under a name of its own and then renamed, which fails
        where the target exists.
        """
        number = base.number + 1
        own = self._path(f"{MANIFESTS}/{uuid.uuid4().hex}.part")
        stream = self._fs.create(own, False)
        stream.write(bytearray(json.dumps(dict(tables)).encode()))
        stream.close()
        none = getattr(self._hadoop, "Options$Rename").NONE
        options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 1)
        options[0] = none
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(own, self._path(f"{MANIFESTS}/{number:012d}.json"), options)
        except (Py4JJavaError, PySparkException) as error:
            self._fs.delete(own, False)
            if number in self.numbers():
                raise Conflict(f"version {number} of {self.root} was published by another writer") from error
            raise
        return Version(number, dict(tables))

    def prune(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` versions, and the folders that only those name."""
        numbers = self.numbers()
        kept = {path for n in numbers[-keep:] for t in self.read(n).tables.values() for path in t["folders"].values()}
        for number in numbers[:-keep]:
            old = self.read(number)
            # The manifest first: a version is there with all of its folders or not at all.
            self._fs.delete(self._path(f"{MANIFESTS}/{number:012d}.json"), False)
            for table in old.tables.values():
                for path in set(table["folders"].values()) - kept:
                    self._fs.delete(self._hadoop.Path(path), True)


def written(df: DataFrame, folder: str, versions: Versions, part: str | None = None, order: Sequence[str] = ()) -> dict:
    """Write a table into ``folder`` and describe it for a manifest: as one part, or one per
    value of the column ``part``, which the files then leave out."""
    writer = df.hint("rebalance", part) if part else (df.orderBy(*order) if order else df)
    writer.write.partitionBy(*([part] if part else [])).parquet(folder)
    if not part:
        return {"schema": json.loads(df.schema.json()), "folders": {"": folder}}
    names = [n for n in versions.names(folder) if n.startswith(f"{part}=")]
    return {
        "schema": json.loads(df.drop(part).schema.json()),
        "folders": {n.removeprefix(f"{part}="): f"{folder}/{n}" for n in names},
    }
