"""Predictions that a job run again goes on with where it was ended.

Features lie in parts, and each part's predictions are a table of their own that is finished
once its writer has committed it.  A manifest holds what the predictions depend on; a run with
anything else is refused instead of mixed in.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakwise.sources.tables import finished, write_table

#: Column and folder prefix of the parts.
PART = "_part"


class OtherInputs(ValueError):
    """The folder holds results of other inputs, settings or another model."""


def check_manifest(spark: SparkSession, path: str, **facts: object) -> None:
    """Write ``facts`` to ``path``, or compare them with those written before."""
    told = json.dumps(facts, sort_keys=True, default=str)
    if finished(spark, path):
        held = spark.read.text(path, wholetext=True).first()[0].rstrip("\n")
        if held != told:
            names = {*facts, *json.loads(held)}
            other = sorted(n for n in names if json.loads(told).get(n) != json.loads(held).get(n))
            raise OtherInputs(f"{path} was made with other values of {', '.join(other)}")
        return
    spark.createDataFrame([(told,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def predict_in_parts(
    features: DataFrame,
    embed: Callable[[DataFrame], DataFrame],
    path: str,
    parts: int,
    **facts: object,
) -> DataFrame:
    """``embed(features)``, written below ``path`` part by part.

    ``embed`` adds columns or drops some, row by row.  A row's part is the digest of all its
    columns but maps, so rows are dealt evenly and alike in every run; equal rows share a part,
    within which Spark splits them like any others.  Called again on the same ``path``, only
    parts that are not finished are embedded: a part that was ended halfway is replaced, since
    its writer committed nothing.  ``facts`` say what predictions depend on, such as the input
    files, the settings and the model's digest; other values than those of the first call are
    an error.
    """
    spark = features.sparkSession
    if parts < 1:
        raise ValueError("parts must be at least 1")
    check_manifest(spark, f"{path}/manifest", parts=parts, columns=features.dtypes, **facts)
    hashed = [F.col(f"`{c}`") for c, kind in features.dtypes if "map<" not in kind]
    part = F.pmod(F.xxhash64(*hashed), F.lit(parts)).cast("int")
    dealt = write_table(
        features.withColumn(PART, part), f"{path}/features", apart_by=PART, resume=True
    )
    predictions = embed(features)
    for number in range(parts):
        own = f"{path}/predictions/{PART}={number}"
        if not finished(spark, own):
            rows = embed(dealt.where(F.col(PART) == number).drop(PART))
            rows.write.mode("overwrite").parquet(own)
    return spark.read.schema(predictions.schema).parquet(f"{path}/predictions").select(
        *predictions.columns
    )
