"""Fixed schemas of the layers (never inferred)."""

from pyspark.sql import types as T

RAW_ROWS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("race_key", T.StringType()),
    T.StructField("row_no", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

RESULTS = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("race", T.StringType()),
    T.StructField("race_role", T.StringType()),
    T.StructField("division", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("time_s", T.DoubleType()),
    T.StructField("overall_place", T.LongType()),
    T.StructField("division_place", T.LongType()),
    T.StructField("location", T.StringType()),
])

EVENT_POINTS = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("division", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("division_place", T.LongType()),
    T.StructField("race_role", T.StringType()),
    T.StructField("points", T.DoubleType()),
])

# The hand-over file of one event and division (the report form of EVENT_POINTS).
EVENT_POINTS_FILE = T.StructType([
    T.StructField("gender_place", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("age_advantage_event_points", T.DoubleType()),
])

MEMBERSHIP = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("team_name", T.StringType()),
    T.StructField("division", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
])

EVENTS_DIM = T.StructType([
    T.StructField("season", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("human_name", T.StringType()),
    T.StructField("event_days", T.IntegerType()),
    T.StructField("seq", T.IntegerType()),
])

# ``participation_mode``: consolidate (default), dedupe or none
EVENTS_DIM_MODES = T.StructType(EVENTS_DIM.fields + [T.StructField("participation_mode", T.StringType())])

ALIASES = T.StructType([
    T.StructField("alias_fn", T.StringType()),
    T.StructField("alias_ln", T.StringType()),
    T.StructField("actual_fn", T.StringType()),
    T.StructField("actual_ln", T.StringType()),
])

ADJUSTMENTS = T.StructType([
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("bias_adjustment", T.DoubleType()),
])

AGE_BANDS = T.StructType([
    T.StructField("lower", T.IntegerType()),
    T.StructField("upper", T.IntegerType()),
    T.StructField("age_group", T.StringType()),
])

# What a reader could not turn into rows: which reader, file or document, line or row, its text, and why
REJECTS = T.StructType([
    T.StructField("reader", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("reason", T.StringType()),
])
