"""Running a detector over a table of frames or images."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

from boxframe.schemas import FRAME_PREDICTION


def score_frames(
    frames: DataFrame,
    factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    keep: list[str],
    **params: Any,
) -> DataFrame:
    """Add ``detections`` and the three stage times to the ``keep`` columns of every frame.

    ``factory`` runs once per task and returns the detector, so a model is loaded once per task and
    only where it is used. The detector gets a pandas batch plus ``params`` and returns a frame with
    the columns of ``FRAME_PREDICTION``, one row per input row.
    """
    kept = ", ".join(f"`{c}` {frames.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = factory()
        for batch in batches:
            scored = detector(batch, **params)
            if len(scored) != len(batch):
                raise ValueError("the detector must return one row per frame")
            yield pd.concat(
                [batch[keep].reset_index(drop=True), scored.reset_index(drop=True)], axis=1
            )

    return frames.mapInPandas(run, f"{kept}, {FRAME_PREDICTION}")
