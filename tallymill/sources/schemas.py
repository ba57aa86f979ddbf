"""Column layouts of the input files. All names and types are fixed values of the file formats."""

from __future__ import annotations

POWER = (
    "Date string, Time string, Global_active_power float, Global_reactive_power float, Voltage float, "
    "Global_intensity float, Sub_metering_1 float, Sub_metering_2 float, Sub_metering_3 float"
)
NEWS = (
    "IDLink bigint, Title string, Headline string, Source string, Topic string, PublishDate timestamp, "
    "SentimentTitle float, SentimentHeadline float, Facebook float, GooglePlus float, LinkedIn float"
)
MOVIES = "MovieID bigint, Title string, Genre string"
RATINGS = "UserID bigint, MovieID bigint, Rating float, Timestamp bigint"
USERS = "UserID bigint, Gender string, Age int, Occupation int, `Zip-code` int"
EDGES = "FromNodeId bigint, ToNodeId bigint"
HIRE_TRAIN = "Zone_ID int, Date date, Hour_slot int, Hire_count int"
HIRE_TEST = "Test_ID bigint, Zone_ID int, Date date, Hour_slot int, Hire_count int"
GPS = "Datetime string, Longitude_X float, Latitude_Y float, Zone_ID int"
ZONES = "Zone_ID int, left float, top float, right float, bottom float"

TOPICS = ["obama", "economy", "palestine", "microsoft"]
PLATFORMS = ["Facebook", "GooglePlus", "LinkedIn"]
RECORD_TAG = "reuters"
BODY_TAG = "body"


def feedback(ticks: int) -> str:
    """Layout of a popularity file: the item id and one column per tick, TS1 onwards."""
    return ", ".join(["IDLink double", *(f"TS{i} double" for i in range(1, ticks + 1))])
