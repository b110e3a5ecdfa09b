"""Run a scoring function over documents and unpack what it returns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# What a scorer returns per document: a short result text, or an exception.
Scorer = Callable[[str, str], str]

OUTPUT = "output struct<processed: string, error_message: string, op_file_path: string, processed_date: string>"


def apply_scorer(df: DataFrame, scorer: Scorer, key: str, text: str, run_date: str) -> DataFrame:
    """Add the ``output`` struct: status, error message, result and date, one call per document.

    A failing document gets ``processed='Failed'`` and the message; the job goes on.  Texts stream through in
    Arrow batches.  Keep the result (write it) before using it twice, or the scorer runs twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = []
            for name, body in zip(batch[key], batch[text]):
                try:
                    results.append(("Success", None, scorer(name, body), run_date))
                except Exception as error:
                    results.append(("Failed", str(error), None, run_date))
            fields = ["processed", "error_message", "op_file_path", "processed_date"]
            batch["output"] = [dict(zip(fields, r)) for r in results]
            yield batch

    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{plain}, {OUTPUT}")


def unpack(scored: DataFrame) -> DataFrame:
    """The output struct as columns."""
    return scored.select(
        *[c for c in scored.columns if c != "output"],
        F.col("output.processed").alias("status"),
        F.col("output.error_message").alias("error_message"),
        F.col("output.processed_date").alias("processed_date"),
        F.col("output.op_file_path").alias("output_file_path"),
    )
