"""Forecast error metrics as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import scaled_round


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (),
                       digits: int | None = 4) -> DataFrame:
    """MAE, RMSE, MAPE (percent), R² and counts over rows where both sides
    are present. MAPE skips rows with ``y = 0`` (counted in ``n_mape_skip``)
    instead of dividing by zero. R² = 1 - SSE / (n * var_pop(y))."""
    e = F.col(y) - F.col(yhat)
    both = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    ape = F.try_divide(F.abs(e), F.abs(F.col(y)))
    out = both.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(ape) * F.lit(100.0)).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(y) == 0).alias("n_mape_skip"),
    )
    if digits is not None:
        out = out.withColumns({m: scaled_round(m, digits) for m in ("mae", "rmse", "mape", "r2")})
    return out

