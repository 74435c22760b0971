"""aerolith: hourly sensor measurements, weather context and daily forecasting
features as Spark DataFrame jobs.

Layers:
  sources/    landed JSON readers, driver-table readers, Parquet/CSV sinks
  functions/  column expressions (rounding, exact means, calendar parts)
  operators/  reusable DataFrame -> DataFrame building blocks
  plans/      the air-quality refresh (silver, gold, features, export, models)
              and the same operators mapped onto the driver tables
"""

__all__ = ["session"]
