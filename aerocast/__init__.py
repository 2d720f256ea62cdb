"""aerocast: air-quality analytics on Spark.

Monthly features from daily pollutant and weather readings, grouped forecasts,
prediction-grid alignment, breakpoint air-quality indices and forecast
evaluation, as DataFrame / Spark SQL / pyspark.ml / Structured Streaming jobs.
"""

__version__ = "0.1.0"
