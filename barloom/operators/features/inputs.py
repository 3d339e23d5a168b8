"""Row-level inputs shared by the feature families, computed once for all of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.nulls import negative_part, positive_part, ratio, zero_to_null
from barloom.operators.frames import Frames
from barloom.operators.panel import Panel

# Horizons of the relative changes, in rows.
RETURN_ROWS = (1, 3, 5, 10, 20)

FILL = {"_close": "Close", "_volume": "Volume"}


def with_inputs(panel: Panel) -> Panel:
    w = Frames(panel)
    panel = w.apply(
        {f"_prev_{c.lower()}": w.lag(c) for c in ("High", "Low", "Close")}
        | {f"return_{k}d": w.change("_close", k) for k in RETURN_ROWS}
        | {"vol_change_1d": w.change("_volume", 1)}
    )
    high, low, close, volume = (F.col(c) for c in ("High", "Low", "Close", "Volume"))
    step = close - F.col("_prev_close")
    spread = high - low
    return panel.with_columns(
        {
            "_spread": spread,
            # greatest() skips NULLs: the first row of a series has only its own spread
            "_true_range": F.greatest(spread, F.abs(high - F.col("_prev_close")), F.abs(low - F.col("_prev_close"))),
            "_gain": positive_part(step),
            "_loss": negative_part(step),
            "_typical": (high + low + close) / 3,
            "_flow": ratio((close - low) - (high - close), zero_to_null(spread)) * volume,
            "_signed_volume": F.signum(step) * volume,
            "_return_volume": F.col("return_1d") * volume,
        }
    )
