"""Gap alerts per meter in event-time order, however the stream is cut into batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meterlake import config
from meterlake.operators.clean import METER, TIME
from meterlake.streaming.windows import event_time

_OUT = "Meter_ID string, expected_us long, actual_us long, time_gap_minutes long, gap_type string"
_STATE = "last_us long, open_us binary"
_MINUTE = 60_000_000


def _alerts(minutes: int, idle_us: int):
    def on_batch(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = state.get if state.exists else (None, b"")
        times = [np.frombuffer(held, "int64"), *(p["us"].to_numpy("int64") for p in parts)]
        times = np.unique(np.concatenate(times))  # copies of a time are one reading
        if last is not None:
            times = times[times > last]
        # Until the watermark has passed a time, an earlier one may still come.
        watermark = state.getCurrentWatermarkMs() * 1000
        settled = times <= watermark
        done, still = times[settled], times[~settled]
        chain = done if last is None else np.concatenate([[last], done])
        steps = chain[1:] // _MINUTE - chain[:-1] // _MINUTE
        odd = steps != minutes
        newest = int(chain[-1]) if len(chain) else None
        if not len(still) and newest is not None and newest + idle_us <= watermark:
            if state.exists:
                state.remove()  # idle for so long that it starts anew
        else:
            state.update((newest, still.tobytes()))
            wake = int(still[0]) if len(still) else newest + idle_us
            state.setTimeoutTimestamp(wake // 1000 + 1)
        yield pd.DataFrame(
            {
                "Meter_ID": key[0],
                "expected_us": chain[:-1][odd],
                "actual_us": chain[1:][odd],
                "time_gap_minutes": steps[odd],
                "gap_type": np.where(steps[odd] > minutes, "Missing readings", "Duplicate period"),
            }
        )

    return on_batch


def gap_alerts(
    df: DataFrame, minutes: int = config.EXPECTED_GAP_MINUTES, delay: str = "1 hour", idle_days: int = 400
) -> DataFrame:
    """Steps from a meter's reading to its next later one that differ from the expected minutes.

    A step is told once the watermark has passed its end, so the alerts are those of the batch
    query for any cut into batches in which no reading is later than ``delay``.  The state is
    the last settled time of each meter and the times within the delay.  A meter without a
    reading for ``idle_days`` behind the watermark leaves the state by a timer; should it come back,
    it starts like a new one, and the step over its absence is not told.
    """
    timed = event_time(df.filter(F.col(METER).isNotNull() & F.col(TIME).isNotNull()), delay)
    timed = timed.select(METER, TIME, F.unix_micros(TIME).alias("us"))
    alerts = timed.groupBy(METER).applyInPandasWithState(
        _alerts(minutes, idle_days * 86_400_000_000), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return alerts.select(
        METER,
        F.timestamp_micros("expected_us").cast("timestamp_ntz").alias("expected_time"),
        F.timestamp_micros("actual_us").cast("timestamp_ntz").alias("actual_time"),
        "time_gap_minutes",
        "gap_type",
    )
