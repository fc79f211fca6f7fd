"""Outputs of a micro-batch that appear together (K6-K8), and what replays and readers go by.

``manifest/<n>.json`` is written once, by a rename, after every output of batch n is in
place. It holds the batch's clock, its counts and, for each output, the folders that belong to
it. The newest manifest is the pointer that readers follow: they never see the outputs of
two batches, and a replayed batch that finds its manifest writes nothing.

A folder goes when the last of the ``KEPT`` newest manifests no longer names it (readers
under way still hold an older one), so the number of folders stays bounded.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession

from clickpulse.sinks.files import SharedFiles

#: Manifests whose folders stay.
KEPT = 3


class Manifests:
    def __init__(self, spark: SparkSession, root: str):
        self.files, self.root = SharedFiles(spark), root

    def _path(self, batch: int) -> str:
        return os.path.join(self.root, "manifest", f"{batch:012d}.json")

    def batches(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(os.path.dirname(self._path(0))) if n.endswith(".json") and not n.startswith(("_", "."))]

    def get(self, batch: int) -> dict | None:
        return json.loads(self.files.read(self._path(batch))) if batch >= 0 and self.files.exists(self._path(batch)) else None

    def newest(self) -> dict | None:
        found = self.batches()
        return self.get(found[-1]) if found else None

    def publish(self, manifest: dict) -> None:
        """Make ``manifest`` (``batch``, ``folders``: paths below the root, ...) the newest; remove what no kept one names."""
        self.files.write(self._path(manifest["batch"]), json.dumps(manifest, sort_keys=True))
        known = self.batches()
        kept = {f for b in known[-KEPT:] for f in self.get(b)["folders"]}
        for old in known[:-KEPT]:
            for folder in set(self.get(old)["folders"]) - kept:
                self.files.delete(os.path.join(self.root, folder))
            self.files.delete(self._path(old))
