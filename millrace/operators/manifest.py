"""A small versioned file that says which folders make up a table.

Each change is a new file, put in place by a rename that fails if the version is there already: two writers cannot both
make the same version, and readers see one version or the next. Folders that a version names are never written again, so
a frame that was opened on it keeps its rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

PLACE = "_manifest"  # a name that Spark's readers of the folder skip
KEPT = 50            # versions that stay


class Manifest:
    """The versions below ``path``. States are plain JSON values."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path}/{PLACE}"

    def _place(self, name: str = ""):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _versions(self) -> list[int]:
        store, place = self._place()
        if not store.exists(place):
            return []
        names = [s.getPath().getName() for s in store.listStatus(place)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _name(self, version: int) -> str:
        return f"{version:012d}.json"

    def latest(self) -> tuple[int, dict | None]:
        """Number and state of the last version; (0, None) before the first."""
        versions = self._versions()
        if not versions:
            return 0, None
        store, place = self._place(self._name(versions[-1]))
        stream = store.open(place)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return versions[-1], json.loads(text)

    def put(self, version: int, state: dict) -> bool:
        """Make a version; False if another writer was first."""
        store, draft = self._place(f".{uuid.uuid4().hex}")
        out = store.create(draft, True)
        try:
            out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        finally:
            out.close()
        _, place = self._place(self._name(version))
        if store.exists(place) or not store.rename(draft, place):
            store.delete(draft, False)
            return False
        for old in self._versions()[:-KEPT]:
            store.delete(self._place(self._name(old))[1], False)
        return True

    def change(self, to: Callable[[dict | None], dict]) -> dict:
        """Apply a change to the last state, again if another writer comes in between."""
        while True:
            version, state = self.latest()
            fresh = to(state)
            if fresh == state or self.put(version + 1, fresh):
                return fresh
