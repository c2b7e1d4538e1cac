"""Saved, versioned models that a running stream takes up at a batch boundary."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from textpulse.operators.model import hybrid_scorer
from textpulse.operators.scoring import Scorer
from textpulse.sinks.folders import SharedFolder


class ModelStore:
    """Models below a folder, each under its version; the newest entry names the current one.

    A version is written once and never changed. Publishing is a new entry renamed into place,
    so a reader sees a whole model or the one before, and going back to an older version is an
    entry as well.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        scorer: Callable[[PipelineModel], Scorer] = hybrid_scorer,
    ) -> None:
        self.spark, self.path = spark, path
        self._scorer = scorer
        self._entries = SharedFolder(spark, f"{path}/_published")
        self._versions = SharedFolder(spark, f"{path}/versions")
        self._loaded: dict[str, PipelineModel] = {}

    def _folder(self, version: str) -> str:
        if not version or "/" in version or version.startswith((".", "_")):
            raise ValueError(f"not a version: {version!r}")
        return f"{self.path}/versions/{version}"

    def save(self, model: PipelineModel, version: str, publish: bool = True) -> None:
        """Write a new version; an existing one is an error."""
        model.write().save(self._folder(version))
        self._loaded[version] = model
        if publish:
            self.publish(version)

    def versions(self) -> list[str]:
        return [name for name in self._versions.names() if not name.startswith((".", "_"))]

    def publish(self, version: str) -> None:
        """Make a saved version the current one."""
        if version not in self.versions():
            raise ValueError(f"no model {version!r} at {self.path}")
        while True:
            names = self._names()
            number = int(names[-1].split(".")[0]) + 1 if names else 1
            if self._entries.put_new(f"{number:012d}.json", json.dumps({"version": version})):
                return

    def _names(self) -> list[str]:
        return [name for name in self._entries.names() if name[0].isdigit()]

    def current(self) -> str | None:
        """The published version; None as long as there is none."""
        names = self._names()
        return json.loads(self._entries.read(names[-1]))["version"] if names else None

    def load(self, version: str | None = None) -> PipelineModel:
        """A saved model, the current one unless a version is given; read once."""
        version = version or self.current()
        if version is None:
            raise ValueError(f"no model is published at {self.path}")
        if version not in self._loaded:
            self._loaded[version] = PipelineModel.load(self._folder(version))
        return self._loaded[version]

    def scorer(self, version: str | None = None) -> Scorer:
        return self._scorer(self.load(version))
