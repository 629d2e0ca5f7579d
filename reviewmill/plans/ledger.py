"""A ledger of finished configurations, so that an interrupted model comparison goes on where it stopped.

Each entry is a folder of its own under the ledger's path: the out-of-fold predictions of one configuration, named by
the configuration and by a fingerprint of the rows it was fitted on. Spark writes the folder and marks it complete
last; a folder without the mark is as if it were not there and is written again. Entries of other rows, folds
or labels have another fingerprint and are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from urllib.parse import quote

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators import models
from reviewmill.operators.features import Block
from reviewmill.plans import grid

COMPLETE = "_SUCCESS"


def fingerprint(rows: DataFrame) -> str:
    """A digest of training rows, whatever their order: their number, and two sums over their hashes."""
    row = F.struct("doc_id", "label", "fold", vector_to_array("features"))
    low, high = (F.pmod(F.xxhash64(row, F.lit(seed)), F.lit(1 << 31)) for seed in (1, 2))
    n, a, b = rows.agg(F.count(F.lit(1)), F.sum(low), F.sum(high)).first()
    return f"{n:x}-{(a or 0):x}-{(b or 0):x}"


class Ledger:
    """The finished configurations under a path that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def entry(self, config: tuple[str, ...], digest: str) -> str:
        return f"{self.path}/{digest}/" + "/".join(quote(part, safe="") for part in config)

    def has(self, config: tuple[str, ...], digest: str) -> bool:
        files, mark = self._files(f"{self.entry(config, digest)}/{COMPLETE}")
        return files.exists(mark)

    def read(self, config: tuple[str, ...], digest: str) -> DataFrame:
        named = [F.lit(value).alias(name) for name, value in zip(grid.CONFIG, config)]
        return self.spark.read.parquet(self.entry(config, digest)).select(*named, "*")

    def add(self, config: tuple[str, ...], digest: str, predictions: DataFrame) -> None:
        predictions.write.mode("overwrite").parquet(self.entry(config, digest))


def resumed_predictions(
    ledger: Ledger,
    inputs: Mapping[tuple[str, str], Block | Callable[[], Block]],
    labels: DataFrame,
    registry: Mapping[str, object] = models.REGISTRY,
    k: int = 5,
    shuffle_key=None,
) -> DataFrame:
    """Out-of-fold predictions of all configurations; those in the ledger are read, the others fitted and added.

    One run, and an interrupted run with any number of restarts, give the same rows.
    """
    parts = []
    for (scope, representation), block in inputs.items():
        rows = grid.training_rows(block() if callable(block) else block, labels, k, shuffle_key)
        digest = fingerprint(rows)
        for model, make in registry.items():
            config = (scope, representation, model)
            if not ledger.has(config, digest):
                ledger.add(config, digest, models.cross_validated(rows, make))
            parts.append(ledger.read(config, digest))
    if not parts:
        raise ValueError("no configuration")
    return reduce(DataFrame.unionByName, parts)
