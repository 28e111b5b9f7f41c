"""Small hand-made observation tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

OBS = (
    "time timestamp, date date, latitude double, longitude double, precipitation_surface double,"
    " temperature_2m double, wind_u_10m double, wind_v_10m double"
)


def day_rows(day: date, cells=((50.0, 10.0),), hours=24, **overrides):
    """``hours`` rows per cell; an override is a value, or a function of (hour, cell number)."""
    values = {"precipitation_surface": 0.5, "temperature_2m": 10.0, "wind_u_10m": 3.0, "wind_v_10m": 4.0, **overrides}
    rows = []
    for number, (lat, lon) in enumerate(cells):
        for hour in range(hours):
            at = datetime(day.year, day.month, day.day) + timedelta(hours=hour)
            row = [v(hour, number) if callable(v) else v for v in values.values()]
            rows.append((at, day, lat, lon, *row))
    return rows


def observations(spark, *days):
    return spark.createDataFrame([row for rows in days for row in rows], OBS)
