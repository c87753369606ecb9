"""Scoring of new applications as they arrive, with train-fitted state."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loanloom.operators.features import BaseFeatureEngineer
from loanloom.operators.training import assemble, score
from loanloom.schema import ID_COL


def score_rows(rows: DataFrame, engineer: BaseFeatureEngineer, model: PipelineModel,
               cols: Sequence[str], encode: Callable[[DataFrame], DataFrame] | None = None,
               id_col: str = ID_COL) -> DataFrame:
    """(ID, score) of batch or streaming rows; no refit and no training rows.

    All steps are stateless. Ranks within the rows passed in depend on all of
    them, so an engineer with such ranks is refused for a stream; with
    ``ranks="fitted"`` they come from the training rows.
    """
    if rows.isStreaming and engineer.ranks is True:
        raise ValueError('ranks need the whole table; use BaseFeatureEngineer(ranks="fitted") or ranks=False')
    made = engineer.transform(rows)
    if encode is not None:
        made = encode(made)
    return score(model, assemble(made, cols, (id_col,)), [id_col])


def start_scoring(stream: DataFrame, out_path: str, checkpoint_path: str, event_time: str | None = None, delay: str = "1 hour",
                  **state) -> StreamingQuery:
    """Append scores as parquet; exactly once per input file by the checkpoint.

    With ``event_time``, rows that repeat an ID within ``delay`` of it are scored
    once: the IDs seen are state, dropped as the watermark passes them.
    """
    if event_time:
        stream = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([state.get("id_col", ID_COL)])
    return (score_rows(stream, **state).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start(out_path))
