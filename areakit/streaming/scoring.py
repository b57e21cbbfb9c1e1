"""Scoring a message stream with the fitted model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areakit.plans.rooms import PREDICTED, load_model
from areakit.streaming.messages import (
    CATEGORY,
    PRICE,
    accepted,
    append_to,
    parse_messages,
    run_for,
)


def score_messages(messages: DataFrame, model: PipelineModel) -> DataFrame:
    """Predicted label index and number of rooms of each complete message.

    Works on batch and streaming frames. The messages carry no label; the label
    indexer passes them through.
    """
    scored = model.transform(accepted(parse_messages(messages)))
    return scored.select(CATEGORY, PRICE, "prediction", F.col(PREDICTED).alias("predicted_rooms"))


def score_stream(
    messages: DataFrame,
    model_path: str,
    checkpoint: str,
    fmt: str = "console",
    path: str | None = None,
    every: str | None = None,
    seconds: int | None = None,
) -> None:
    """Score a message stream with a saved model into a sink for some time.

    With ``seconds`` it takes messages as they arrive until the time is up, without any it
    ends when it has caught up; see :func:`areakit.streaming.messages.append_to`.
    """
    scored = score_messages(messages, load_model(model_path))
    query = append_to(scored, checkpoint, fmt, path, every, once=seconds is None)
    run_for(query, seconds)
