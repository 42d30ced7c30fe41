"""Column-level functions (projections, decoders, small formatters).

All of them return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage code generation and work on streams unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- fixed values that must equal the reference's -------------------------
# Line colours in the order a stop's flags are tested (first true wins).
LINE_FLAGS = ("red", "blue", "green")
UNKNOWN_LINE = "unknown"
# Board order of lines.
BOARD_LINE_ORDER = ("blue", "green", "red")
# Display colour per line, and the code used for anything else.
LINE_COLOR_CODES = {"blue": "#1E90FF", "red": "#DC143C", "green": "#32CD32"}
OTHER_COLOR_CODE = "0xFFFFFF"
# Domains of the enumerations sent by name.
DIRECTIONS = ("a", "b")
TRAIN_STATUSES = ("out_of_service", "in_service", "broken_down")
WEATHER_STATUSES = ("sunny", "partly_cloudy", "cloudy", "windy", "precipitation")
# Weather shown before any reading arrives.
DEFAULT_TEMPERATURE = 70.0
DEFAULT_WEATHER_STATUS = "sunny"
# Placeholder for an empty slot on the board.
EMPTY_SLOT = "---"
# Summary topic name as the aggregate layer upper-cases it.
TOPIC_SUMMARY = "TURNSTILE_SUMMARY"
# ---------------------------------------------------------------------------

# Topic names of this deployment (any names work; routing keys on them).
TRANSIT_PREFIX = "transit"
STATION_TOPIC_STEM = f"{TRANSIT_PREFIX}.station"
TOPIC_CALLS = "police.calls.v1"
TOPIC_STATIONS_RAW = f"{TRANSIT_PREFIX}.stations"
TOPIC_STATIONS_TABLE = f"{TRANSIT_PREFIX}.stations.table.v1"
TOPIC_ARRIVALS = f"{STATION_TOPIC_STEM}.arrivals.v1"
TOPIC_TURNSTILE = f"{STATION_TOPIC_STEM}.turnstile.v1"
TOPIC_WEATHER = f"{TRANSIT_PREFIX}.weather.v1"
# Pattern the board subscribes to for arrivals.
ARRIVALS_TOPIC_PATTERN = f"^{STATION_TOPIC_STEM}.arrivals.*"
# ---------------------------------------------------------------------------

# Full-precision timestamp text for JSON values (default JSON formats keep ms).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_OPTIONS = {"timestampFormat": JSON_TS_FORMAT}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# PRJ-1 bytes to text
def as_text(c="value") -> Column:
    return _c(c).cast("string")


# PRJ-2 JSON decode; expand with ``select("d.*")``. Times are read in any form
# Spark's reader takes: T or a space, any precision, with or without a zone.
def decode_json(c, schema: StructType) -> Column:
    return F.from_json(as_text(c), schema)


# PRJ-16 JSON encode of named columns (UTF-8 text; cast to binary for a topic)
def encode_json(*cols) -> Column:
    return F.to_json(F.struct(*[_c(c) for c in cols]), JSON_OPTIONS)


# PRJ-5 line colour: first true flag, else unknown
def line_color(red="red", blue="blue", green="green") -> Column:
    return (F.when(_c(red), F.lit("red"))
            .when(_c(blue), F.lit("blue"))
            .when(_c(green), F.lit("green"))
            .otherwise(F.lit(UNKNOWN_LINE)))


# PRJ-8 known-line filter predicate
def is_known_line(c="line") -> Column:
    return _c(c).isin(*LINE_FLAGS)


# PRJ-10 display colour code
def color_code(c="line") -> Column:
    expr = None
    for line, code in LINE_COLOR_CODES.items():
        expr = (F.when(_c(c) == line, F.lit(code)) if expr is None
                else expr.when(_c(c) == line, F.lit(code)))
    return expr.otherwise(F.lit(OTHER_COLOR_CODE))


# SRT-2 rank of a line on the board
def board_line_rank(c="line") -> Column:
    expr = None
    for i, line in enumerate(BOARD_LINE_ORDER):
        expr = (F.when(_c(c) == line, F.lit(i)) if expr is None
                else expr.when(_c(c) == line, F.lit(i)))
    return expr.otherwise(F.lit(len(BOARD_LINE_ORDER)))


# PRJ-11 underscores to spaces
def spaced(c) -> Column:
    return F.replace(_c(c), F.lit("_"), F.lit(" "))


# PRJ-12 title case of an enum name: partly_cloudy -> Partly Cloudy
def title_words(c) -> Column:
    return F.initcap(spaced(c))


# PRJ-13 truncate toward zero
def truncate_int(c) -> Column:
    return _c(c).cast("int")


# PRJ-14 placeholder for null
def or_placeholder(c, placeholder: str = EMPTY_SLOT) -> Column:
    return F.coalesce(_c(c), F.lit(placeholder))


# PRJ-15 name slug: lower; '/' -> '_and_'; ' ' and '-' -> '_'; drop "'"
def name_slug(c) -> Column:
    s = F.lower(_c(c))
    for old, new in (("/", "_and_"), (" ", "_"), ("-", "_"), ("'", "")):
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


# PRJ-17 event time as epoch milliseconds, rounded half to even
def epoch_ms_key(ts) -> Column:
    micros = F.unix_micros(_c(ts).cast("timestamp"))
    return F.bround(micros / F.lit(1000.0), 0).cast("bigint")


def from_epoch_ms(c) -> Column:
    return F.timestamp_millis(_c(c))


# PRJ-18 calendar parts; weekday is Monday = 0
def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_of_week(ts) -> Column:
    return F.weekday(_c(ts))


# PRJ-19 rounding helpers
def round_half_even(c) -> Column:
    return F.bround(_c(c), 0)


def clamp_at_zero(c) -> Column:
    return F.greatest(_c(c), F.lit(0))


# STR-6 rule 4: direction a is slot a, anything else slot b
def slot_of(direction) -> Column:
    return F.when(_c(direction) == "a", F.lit("a")).otherwise(F.lit("b"))


# PRJ-20 a value that is present but isn't a JSON object. The text is parsed a
# second time only where no wanted field was found in it.
def is_malformed(value, decoded, fields) -> Column:
    empty = F.lit(True)
    for f in fields:
        empty = empty & _c(decoded).getField(f).isNull()
    text = as_text(value)
    is_object = F.coalesce(F.get_json_object(text, "$").startswith("{"), F.lit(False))
    return text.isNotNull() & F.when(empty, ~is_object).otherwise(F.lit(False))
