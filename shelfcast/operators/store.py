"""Named models in a folder."""

from __future__ import annotations

import importlib

from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import SparkSession

from shelfcast.sources.sinks import child_names

# Fixed value: ending of a stored model's folder.
SUFFIX = ".sm"


class ModelStore:
    """Models by exact name; the class is taken from the metadata Spark writes with them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}{SUFFIX}"

    def names(self) -> list[str]:
        entries = child_names(self.spark, self.folder)
        return [e.removesuffix(SUFFIX) for e in entries if e.endswith(SUFFIX)]

    def stored_class(self, name: str) -> type:
        """Python class of the stored model."""
        metadata = DefaultParamsReader.loadMetadata(self._path(name), self.spark.sparkContext)
        module, _, cls = metadata["class"].replace("org.apache.spark", "pyspark").rpartition(".")
        return getattr(importlib.import_module(module), cls)

    def save(self, model: MLWritable, name: str) -> str:
        """Store the model, replacing one of the same class; another class is an error."""
        if name in self.names() and self.stored_class(name) is not type(model):
            raise ValueError(f"{name} is stored as a {self.stored_class(name).__name__}")
        model.write().overwrite().save(self._path(name))
        return self._path(name)

    def load(self, name: str):
        if name not in self.names():
            raise ValueError(f"no model {name} in {self.folder}")
        return DefaultParamsReader.loadParamsInstance(self._path(name), self.spark.sparkContext)
