"""Saved forests.

A model is saved in the shared folder under a name that digests its training rows and parameters, so jobs
that need the same forest fit it once, and changed rows or parameters never meet an old one. Writers publish by
renaming: a name that exists holds a whole model.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

import pyspark
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import ensure_checkpoint_dir
from ..sinks.scratch import hadoop


def load_model(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def fingerprint(rows: DataFrame, cols: Sequence[str], params: dict) -> str:
    """Digest of the rows (in any order) and the parameters."""
    both = [F.xxhash64(F.lit(k), *[F.col(c) for c in cols]).cast(T.DecimalType(38, 0)) for k in (1, 2)]
    told = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).cast("string").alias(f"s{k}") for k, h in enumerate(both)]).first()
    kinds = [[c, dict(rows.dtypes)[c]] for c in cols]
    return hashlib.sha256(json.dumps([list(told), kinds, params, pyspark.__version__], sort_keys=True).encode()).hexdigest()


def stored(rows: DataFrame, cols: Sequence[str], params: dict, fit: Callable[[], RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """The model of these training rows and parameters from the store; fitted and saved first if it isn't there."""
    spark = rows.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/blockbeam-models"
    path = f"{base}/{fingerprint(rows, cols, params)}"
    fs, place = hadoop(spark, path)
    if not fs.exists(place):
        made = f"{base}/.{uuid.uuid4().hex}"
        fit().save(made)
        _, temporary = hadoop(spark, made)
        if fs.exists(place) or not fs.rename(temporary, place):
            fs.delete(temporary, True)  # another job was first
    return load_model(path)
