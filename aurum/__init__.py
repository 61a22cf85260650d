"""aurum: a Spark-native medallion engine for keyed readings.

bronze (raw messages) -> silver (parsed, gated, keep-last, day-partitioned)
-> gold (latest per key, hourly and daily statistics) -> serving queries.
"""

__version__ = "0.1.0"
