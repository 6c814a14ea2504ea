"""Fixed schemas of the data sets (no inference on read).

D1  bronze weather document  - one JSON object per file, parallel hourly arrays
D2  bronze price record      - one JSON array of records per file
D8  live / forecast reading  - one JSON message per reading
D9  market price record      - upstream record, passed through as text
D10 prediction message       - one JSON message per scored reading
"""

from pyspark.sql import types as T

# D1. The wind array arrives under one of two names depending on which ingest
# job asked for it; both are declared so a mix of files reads cleanly.
HOURLY = T.StructType(
    [
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("windspeed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
    ]
)
WEATHER_DOC = T.StructType(
    [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()), T.StructField("hourly", HOURLY)]
)

# Live weather document: one ``current`` struct of single readings.
CURRENT = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("temperature_2m", T.DoubleType()),
        T.StructField("wind_speed_10m", T.DoubleType()),
    ]
)
CURRENT_DOC = T.StructType([T.StructField("current", CURRENT)])

# D2.
PRICE_RECORD = T.StructType(
    [
        T.StructField("HourUTC", T.StringType()),
        T.StructField("SpotPriceEUR", T.DoubleType()),
        T.StructField("PriceArea", T.StringType()),
    ]
)

# D8.
READING = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)

# D9. Only the fields the operators look at; the rest rides along in the text.
MARKET_RECORD = T.StructType(
    [
        T.StructField("TimeUTC", T.StringType()),
        T.StructField("PriceArea", T.StringType()),
        T.StructField("ImbalancePriceEUR", T.DoubleType()),
    ]
)

# D10.
PREDICTION = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("price_rf", T.DoubleType()),
        T.StructField("price_gbt", T.DoubleType()),
    ]
)

# D5/D6. Feature order is part of a fitted model: never reorder.
FEATURES = ["temperature", "wind_speed", "hour_of_day", "day_of_week"]
TIME_FEATURES = ["hour_of_day", "day_of_week"]
LABEL = "label"
