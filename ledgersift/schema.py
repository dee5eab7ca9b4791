"""The transaction table: one row per address and day of year."""

from pyspark.sql import types as T

TXN = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("looped", T.IntegerType()),
    T.StructField("neighbors", T.IntegerType()),
    T.StructField("income", T.LongType()),
    T.StructField("label", T.StringType()),
])

# Class names.
MAJORITY = "white"
MINORITY = "black"

# Column lists.
NUMERIC = ["year", "day", "length", "weight", "count", "looped", "neighbors", "income"]
HISTOGRAM_COLUMNS = ["length", "weight", "count", "looped", "neighbors", "income"]
STATS_COLUMNS = ["income", "weight", "length"]
BOXCOX_COLUMNS = ["length", "income", "weight", "count", "neighbors"]
INTERACTIONS = [("length", "weight"), ("income", "count")]

# Columns that identify a row for repeatable sampling: strings and integers only, because
# engines print doubles differently.
KEY_COLUMNS = ["address", "year", "day", "length", "count", "looped", "neighbors", "income"]

# The two feature presets, in vector order.
TRAINER_FEATURES = [
    "year", "day", "weight", "looped", "num_addresses", "day_of_week",
    "length_weight_interaction", "income_count_interaction",
    "length_boxcox", "income_boxcox", "weight_boxcox", "count_boxcox", "neighbors_boxcox",
]
NOTEBOOK_FEATURES = [
    "year", "day", "length", "weight", "count", "looped", "neighbors", "income",
    "num_addresses", "day_of_week",
    "length_weight_interaction", "income_count_interaction",
    "length_boxcox", "income_boxcox", "weight_boxcox", "count_boxcox", "neighbors_boxcox",
]
