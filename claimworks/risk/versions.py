"""Model versions behind one pointer, switched without a restart."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from claimworks.risk.score import AdditiveScorer, FailedScorer, ModelScorer

KNOWN = ("v1", "v2")


class ModelStore:
    """``<root>/v1``, ``<root>/v2`` and a small ``ACTIVE`` file naming the one in use."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._cached: tuple[str, ModelScorer] | None = None

    def _pointer(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ACTIVE")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def save(self, version: str, model: PipelineModel) -> None:
        self._check(version)
        model.write().overwrite().save(f"{self.root}/{version}")

    def activate(self, version: str) -> None:
        self._check(version)
        path, fs = self._pointer()
        out = fs.create(path, True)
        out.write(bytearray(version.encode()))
        out.close()

    def active(self) -> str:
        return self.spark.read.text(f"{self.root}/ACTIVE").first()[0].strip()

    @staticmethod
    def _check(version: str) -> None:
        if version not in KNOWN:
            raise ValueError(f"unknown version: {version}; expected v1 or v2")

    def load(self, version: str) -> ModelScorer:
        self._check(version)
        return ModelScorer(PipelineModel.load(f"{self.root}/{version}"), version)

    def scorer(self) -> ModelScorer:
        """The active model, read again only when the pointer has changed."""
        version = self.active()
        if self._cached is None or self._cached[0] != version:
            self._cached = (version, self.load(version))
        return self._cached[1]

    def scorer_or_fallback(self) -> ModelScorer | FailedScorer:
        """For batch jobs: a missing model gives the error fallback and not a failed job."""
        try:
            return self.scorer()
        except Exception:  # noqa: BLE001 - any load failure has the same answer
            return FailedScorer()


class FixedModel:
    """A store that always answers with one scorer."""

    def __init__(self, scorer=None) -> None:
        self._scorer = scorer or AdditiveScorer()

    def scorer(self):
        return self._scorer
