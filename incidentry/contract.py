"""The one 47-column contract of an incident table, with its fixed values.

CSV files bind to the contract by position, other formats by name.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The point-of-interest flags, in CSV order.
POI_FLAGS = [
    "Amenity",
    "Bump",
    "Crossing",
    "Give_Way",
    "Junction",
    "No_Exit",
    "Railway",
    "Roundabout",
    "Station",
    "Stop",
    "Traffic_Calming",
    "Traffic_Signal",
    "Turning_Loop",
]

# The 47 columns of the incident CSV, in CSV order.
COLUMNS = [
    "ID",
    "Severity",
    "Start_Time",
    "End_Time",
    "Start_Lat",
    "Start_Lng",
    "End_Lat",
    "End_Lng",
    "Distance(mi)",
    "Description",
    "Number",
    "Street",
    "Side",
    "City",
    "County",
    "State",
    "Zipcode",
    "Country",
    "Timezone",
    "Airport_Code",
    "Weather_Timestamp",
    "Temperature(F)",
    "Wind_Chill(F)",
    "Humidity(%)",
    "Pressure(in)",
    "Visibility(mi)",
    "Wind_Direction",
    "Wind_Speed(mph)",
    "Precipitation(in)",
    "Weather_Condition",
    *POI_FLAGS,
    "Sunrise_Sunset",
    "Civil_Twilight",
    "Nautical_Twilight",
    "Astronomical_Twilight",
]

_TIMES = {"Start_Time", "End_Time", "Weather_Timestamp"}
_MEASURES = {
    "Start_Lat", "Start_Lng", "End_Lat", "End_Lng", "Distance(mi)", "Number",
    "Temperature(F)", "Wind_Chill(F)", "Humidity(%)", "Pressure(in)",
    "Visibility(mi)", "Wind_Speed(mph)", "Precipitation(in)",
}


def _type_of(name: str):
    if name == "Severity":
        return IntegerType()
    if name in _TIMES:
        return TimestampType()
    if name in _MEASURES:
        return DoubleType()
    if name in POI_FLAGS:
        return BooleanType()
    return StringType()


INCIDENT_SCHEMA = StructType([StructField(c, _type_of(c)) for c in COLUMNS])

POPULATION_SCHEMA = StructType(
    [StructField("state", StringType()), StructField("pop", IntegerType())]
)

# Added by the storage layout, not part of the contract.
YEAR_PARTITION = "start_year"

# What the cleaner writes in place of a missing value.
MISSING_NUMBER = -999.0
MISSING_TIME = "0001-01-01 00:00:00"
MISSING_DEFAULTS = {
    "Number": MISSING_NUMBER,
    "City": "CityEmpty",
    "Zipcode": "ZipCodeEmpty",
    "Timezone": "TimezoneEmpty",
    "Airport_Code": "Airport_CodeEmpty",
    "Weather_Timestamp": MISSING_TIME,
    "Temperature(F)": MISSING_NUMBER,
    "Wind_Chill(F)": MISSING_NUMBER,
    "Humidity(%)": MISSING_NUMBER,
    "Pressure(in)": MISSING_NUMBER,
    "Visibility(mi)": MISSING_NUMBER,
    "Wind_Direction": "Wind_DirectionEmpty",
    "Wind_Speed(mph)": MISSING_NUMBER,
    "Precipitation(in)": MISSING_NUMBER,
    "Weather_Condition": "Weather_ConditionEmpty",
    "Sunrise_Sunset": "Sunrise_SunsetEmpty",
    "Civil_Twilight": "Civil_TwilightEmpty",
    "Nautical_Twilight": "Nautical_TwilightEmpty",
    "Astronomical_Twilight": "Astronomical_TwilightEmpty",
}

# Weather bins tried in this order, first match wins. "Thunder"
# stands before the storm bin, so thunderstorms count as rain.
WEATHER_BINS = [
    ("Fog|Overcast|Haze|Mist|Smoke", "Fog"),
    ("Clear|Fair|Cloudy|Clouds|Cloud", "Clear & Cloudy"),
    ("Rain|Showers|Drizzle|Thunder", "Rain"),
    ("Ice|Snow|Sleet|Hail|Wintry", "Snow"),
    ("Storm|storm|Tornado|Squalls", "Storm"),
    ("Sand|Dust", "Sand & Dust"),
]

# The exploratory bins; whatever matches none becomes "Other".
WEATHER_BINS_WITH_OTHER = [
    ("Fog|Overcast|Haze|Mist|Smoke", "Fog"),
    ("Clear|Fair", "Clear"),
    ("Rain|Showers|Drizzle|Thunder", "Rain"),
    ("Ice|Snow|Sleet|Hail", "Snow"),
    ("Storm|storm|Tornado", "Storm"),
    ("Sand|Dust", "Sand"),
    ("Cloudy|Clouds|Cloud", "Cloudy"),
]

# Compass codes to the four main directions, calm and variable.
WIND_GROUPS = {
    "West": ["WSW", "WNW", "W"],
    "South": ["SSW", "SSE", "SW", "S", "SE"],
    "North": ["NNW", "NNE", "NW", "NE", "N"],
    "East": ["ESE", "ENE", "E"],
    "Calm": ["CALM"],
    "Variable": ["VAR"],
}

# The measures of the weather density report.
WEATHER_MEASURES = [
    "Temperature(F)",
    "Humidity(%)",
    "Pressure(in)",
    "Visibility(mi)",
    "Wind_Speed(mph)",
]
