"""gridcast: weather-to-price analytics on Spark DataFrames.

Every public function takes and returns a DataFrame (or a Column), so the same
code runs on a batch table or on a Structured Streaming source.
"""

__version__ = "0.1.0"
