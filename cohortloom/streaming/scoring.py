"""The prediction log as a stream: requests in, scored rows out.

Validation and scoring keep no state, so the batch operators apply as they are.
The file sink with its checkpoint writes every request exactly once, also after
a restart.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortloom.operators import cleaning, model
from cohortloom.schema import CohortSchema


def score_stream(
    requests: DataFrame, schema: CohortSchema, fitted: PipelineModel, run_id: str, version: str
) -> tuple[DataFrame, DataFrame]:
    """(scored requests, refused requests with their errors)."""
    valid, refused = cleaning.validate(requests, schema, scoring=True)
    scored = model.score(valid, fitted, schema.id, schema.labels, run_id, version, F.current_timestamp())
    return scored, refused


def append_stream(rows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream to Parquet. `once` takes what has arrived and stops."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
