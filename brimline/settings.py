"""Fixed values, defaults and schemas."""

from pyspark.sql import types as T

# Names, dates and numbers that results depend on.
LEVEL_SUFFIX = "DolulukOrani"
WEATHER_MEASURES = ("tmax", "tmin", "tavg", "hum", "wind", "sun", "evap", "prcp")
FLAGGED_MEASURES = ("prcp", "evap")
HORIZONS = (7, 14, 30)
DEFAULT_LAGS = (7, 14, 30, 60, 90)
DEFAULT_SEQ_LENS = (30, 60, 90)
DEFAULT_HALFLIVES = (365,)
DEFAULT_MODEL = "GRU"
DEFAULT_STRATEGY = "baseline"
STRATEGIES = ("baseline", "walkfwd_expanding")
SPLIT_DATE = "2023-01-01"
FOLD_MONTHS = 6
MIN_FOLD_TRAIN_ROWS = 60
MIN_EXTRA_ROWS = 10
VALIDATION_SHARE = 0.2
MAX_LEVEL = 100.0
RAIN_DAYS = (7, 30, 90)
TEMP_DAYS = 7
MEAN_ROWS = (30, 180, 365)
STD_ROWS = 30
DATE_FORMATS = ("d.M.yyyy", "d/M/yyyy", "d-M-yyyy", "yyyy-M-d")

PANEL_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("level", T.DoubleType()),
    T.StructField("rain", T.DoubleType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("demand", T.DoubleType()),
])

SETTINGS_SCHEMA = T.StructType([
    T.StructField("prod_cols", T.ArrayType(T.StringType())),
    T.StructField("weather_stations", T.ArrayType(T.StringType())),
    T.StructField("lag_days", T.ArrayType(T.IntegerType())),
    T.StructField("model", T.StringType()),
    T.StructField("seq_lens", T.ArrayType(T.IntegerType())),
    T.StructField("halflives", T.ArrayType(T.IntegerType())),
    T.StructField("strategy", T.StringType()),
])
CONFIG_SCHEMA = T.MapType(T.StringType(), SETTINGS_SCHEMA)
