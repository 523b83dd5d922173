"""Evidence runs: a probe over a worklist, its outcomes merged back."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_probe(worklist: DataFrame, key: str, path: str, probe: Callable[[str], dict]) -> DataFrame:
    """(key, ok, detail json, error) of probe(path) for each row; a raising probe is an outcome, not a failure."""
    kind = worklist.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, p in zip(b[key], b[path], strict=True):
                try:
                    out.append((k, True, json.dumps(probe(p)), None))
                except Exception as e:  # noqa: BLE001  the probe's own error is the evidence
                    out.append((k, False, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["key", "ok", "detail", "error"])

    return worklist.select(key, path).mapInPandas(run, f"key {kind}, ok boolean, detail string, error string").withColumnRenamed("key", key)


def merge_status(blobs: DataFrame, outcomes: DataFrame, key: str, good: str, bad: str) -> DataFrame:
    """blobs with integrity_status and integrity_detail taken from outcomes; broken is never upgraded."""
    o = outcomes.select(F.col(key).alias("__k"), F.col("ok").alias("__ok"), F.coalesce("detail", F.to_json(F.struct("error"))).alias("__d"))
    j = blobs.join(o, F.col(key) == F.col("__k"), "left")
    status = F.when(F.col("__k").isNull() | (F.col("integrity_status") == "broken"), F.col("integrity_status")).when(F.col("__ok"), good).otherwise(bad)
    return j.withColumns({"integrity_status": status, "integrity_detail": F.coalesce("__d", "integrity_detail")}).drop("__k", "__ok", "__d")
