"""Digests kept on disk, read again only if they are whole and belong to the reference and sites at hand.

A table is written first and its manifest last.  The manifest names the reference (length and time of its last change),
the sites, the schema, and every file with its length; a table without one, with other files or for
another reference is passed over and made anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.sites import RestrictionSite
from .digest import cache_key
from .tables import _delete

VERSION = 1


class DigestIndex:
    """The tables of one reference and one set of sites below ``root``."""

    def __init__(self, spark: SparkSession, root: str, reference: str, sites: frozenset[RestrictionSite]):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{cache_key(reference, sites)}"
        self.identity = {
            "version": VERSION, "reference": [list(x) for x in self._files(reference, times=True)],
            "sites": sorted(f"{s.pattern},{s.loc},{s.rev_loc}" for s in sites),
        }

    def _place(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def _files(self, path: str, times: bool = False) -> list[tuple]:
        """(name, length) of the files of a path or pattern, and when they were changed."""
        fs, place = self._place(path)
        found = fs.globStatus(place) or []
        inside = [y for x in found for y in (fs.listStatus(x.getPath()) if x.isDirectory() else [x])]
        return sorted((x.getPath().getName(), x.getLen(), *([x.getModificationTime()] if times else [])) for x in inside if x.isFile())

    def _manifest(self, name: str) -> dict | None:
        fs, place = self._place(f"{self.path}/{name}.json")
        if not fs.exists(place):
            return None
        stream = fs.open(place)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except (ValueError, Py4JJavaError):  # cut short, or its checksum differs: as if there were none
            return None
        finally:
            stream.close()

    def get(self, name: str) -> DataFrame | None:
        """The table, or None if there is none that is whole and fits."""
        known = self._manifest(name)
        if known is None or known.get("identity") != self.identity:
            return None
        at = f"{self.path}/{known['table']}"
        if [list(x) for x in self._files(at)] != known["files"]:
            return None
        return self.spark.read.schema(StructType.fromJson(known["schema"])).parquet(at)

    def put(self, name: str, table: DataFrame) -> DataFrame:
        """Writes a table beside any that is there, and then the manifest that replaces it."""
        before = self._manifest(name)
        at = f"{name}-{uuid.uuid4().hex}"
        table.write.mode("errorifexists").parquet(f"{self.path}/{at}")
        told = {"identity": self.identity, "table": at, "schema": table.schema.jsonValue(), "files": [list(x) for x in self._files(f"{self.path}/{at}")]}
        fs, place = self._place(f"{self.path}/{name}.json")
        out = fs.create(place, True)
        out.write(bytearray(json.dumps(told).encode()))
        out.close()
        if before and before.get("table"):
            _delete(self.spark, f"{self.path}/{before['table']}")
        found = self.get(name)
        assert found is not None
        return found

    def get_or_put(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        found = self.get(name)
        return self.put(name, make()) if found is None else found
