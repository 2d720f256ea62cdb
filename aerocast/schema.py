"""Typed schemas, codes and fixed values of the air-quality pipeline.

Everything downstream works in *long* form: one row per
(param | variable, region, year, month) with a ``value``; columns are spread
wide only for output tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values. These must equal the published ones for results to match.
# --------------------------------------------------------------------------

# Pollutant parameter codes: ozone, SO2, CO, NO2, PM2.5 (two monitors).
POLLUTANTS = ["44201", "42401", "42101", "42602", "88101", "88502"]

# Daily weather series, in the order they are joined onto pollutant months,
# and the feature column each one becomes.
WEATHER_VARIABLES = ["WIND", "TEMP", "RH_DP", "PRESS"]
WEATHER_COLUMNS = {"WIND": "am_wind", "TEMP": "am_temp", "RH_DP": "am_rh", "PRESS": "am_press"}

# Index levels shared by every pollutant.
AQI_LEVELS = [0, 51, 101, 151, 201, 301, 401, 500]

# Concentration breakpoints per pollutant.
CONCENTRATION_LEVELS = {
    "44201": [0, 0.055, 0.071, 0.086, 0.106, 0.201],
    "42401": [0, 36, 76, 186, 305, 605, 805, 1005],
    "42101": [0, 4.5, 9.5, 12.5, 15.5, 30.5, 40.5, 50.5],
    "42602": [0, 54, 101, 361, 650, 1250, 1650, 2050],
    "88502": [0, 12.1, 35.5, 55.5, 150.5, 250.5, 350.5, 500.5],
    "88101": [0, 12.1, 35.5, 55.5, 150.5, 250.5, 350.5, 500.5],
}

# Feature columns of the pollutant models, in model order.
POLLUTANT_FEATURES = ["month", "year", "am_temp", "am_press", "am_wind", "am_rh"]
WEATHER_FEATURES = ["month", "year"]

# Per-region weather training keeps the first 60 months.
WEATHER_TRAINING_MONTHS = 60

# --------------------------------------------------------------------------
# Driver-table mapping (see FIXTURES.md §2.1): how the TPC-H-like tables are
# read as daily pollutant and weather measurements.
# --------------------------------------------------------------------------

# l_returnflag || l_linestatus -> pollutant code
FLAG_TO_POLLUTANT = {"AF": "44201", "AO": "42401", "NF": "42101", "NO": "42602", "RF": "88101", "RO": "88502"}
# o_orderpriority -> weather variable; the two lowest priorities feed one series
PRIORITY_TO_VARIABLE = {"1-URGENT": "WIND", "2-HIGH": "TEMP", "3-MEDIUM": "RH_DP", "4-NOT SPECIFIED": "PRESS",
                        "5-LOW": "PRESS"}
# l_extendedprice is divided by this and scaled to the pollutant's top breakpoint
PRICE_SCALE = 100000.0

BASE_YEAR = 1996  # month 0 of trend fits; no bound on the rows used
GRID_YEAR = 2001
TRAIN_LAST_YEAR = GRID_YEAR - 1



def aqi_column(param: str) -> str:
    return f"aqi_{param}"


def forecast_column(param: str) -> str:
    return f"max_value_pred_{param}"


# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

MEASURES = ["observation_count", "observation_percent", "max_value", "max_hour", "arithmetic_mean"]

# Daily readings are exact: counts, percentages and hours are integers,
# concentrations exact decimals (as written in the source files). Monthly means
# are computed from exact sums and leave as double.
MEASURE_TYPES = {
    "observation_count": T.IntegerType(),
    "observation_percent": T.DecimalType(12, 6),
    "max_value": T.DecimalType(18, 10),
    "max_hour": T.IntegerType(),
    "arithmetic_mean": T.DecimalType(18, 12),
}
WEATHER_MEASURE_TYPE = T.DecimalType(18, 6)

POLLUTANT_DAILY = T.StructType([
    T.StructField("param", T.StringType()),
    T.StructField("state_code", T.IntegerType()),
    T.StructField("county_code", T.IntegerType()),
    T.StructField("date_local", T.DateType()),
    *[T.StructField(m, MEASURE_TYPES[m]) for m in MEASURES],
])

WEATHER_DAILY = T.StructType([
    T.StructField("variable", T.StringType()),
    T.StructField("state_code", T.IntegerType()),
    T.StructField("county_code", T.IntegerType()),
    T.StructField("date_local", T.DateType()),
    T.StructField("arithmetic_mean", WEATHER_MEASURE_TYPE),
])


def sql_type(t) -> str:
    return t.simpleString().upper()


# Header names of the raw daily CSV files (and the typed column
# each feeds); raw file names follow daily_<code>_<year>.csv.
DAILY_CSV_COLUMNS = {
    "State Code": "state_code",
    "County Code": "county_code",
    "Date Local": "date_local",
    "Observation Count": "observation_count",
    "Observation Percent": "observation_percent",
    "1st Max Value": "max_value",
    "1st Max Hour": "max_hour",
    "Arithmetic Mean": "arithmetic_mean",
}

KEYS_STATE = ("state_code",)
KEYS_COUNTY = ("state_code", "county_code")


def staged_daily_schema(base: T.StructType = POLLUTANT_DAILY) -> T.StructType:
    """Schema of a daily table staged as ``param=/year=`` directories."""
    return T.StructType([*base.fields, T.StructField("year", T.IntegerType())])
