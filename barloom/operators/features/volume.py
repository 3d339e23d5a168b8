"""Volume level and the running flow lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.nulls import ratio, zero_to_null
from barloom.operators.frames import Frames

# Fixed value: frame length in rows.
VOLUME_ROWS = 20

OUTPUTS = ("vol_ratio", "vol_change_1d", "obv", "vpt", "adl", "cmf_20")
RUNNING = {"obv": "_signed_volume", "vpt": "_return_volume", "adl": "_flow"}


def volume(w: Frames) -> dict[str, Column]:
    return {
        "vol_ratio": ratio(F.col("Volume"), zero_to_null(w.mean("Volume", VOLUME_ROWS))),
        "cmf_20": ratio(
            w.rolling("sum", "_flow", VOLUME_ROWS),
            zero_to_null(w.rolling("sum", "Volume", VOLUME_ROWS)),
        ),
    }
