"""Hand-written payloads with the edge rows a feed can hold."""

from __future__ import annotations


def place(name, lat=1.0, lon=2.0, **more):
    found = {
        "name": name, "region": "R", "country": "Chad", "lat": lat, "lon": lon,
        "tz_id": "Africa/Ndjamena", "localtime": "2024-01-01 9:05", **more,
    }
    return {k: v for k, v in found.items() if v is not None}


def current(name, lat=1.0, lon=2.0, temp=20.5, weather=None, **more):
    weather = {
        "cloud": 10, "condition": {"text": "Sunny", "code": 1000}, "feelslike_c": 21.0,
        "gust_kph": 5.0, "humidity": 40, "is_day": 1, "last_updated": "2024-01-01 09:00",
        "precip_mm": 0.0, "pressure_in": 29.9, "temp_c": temp, "uv": 4.0,
        "wind_degree": 90, "wind_dir": "E", "wind_kph": 3.0, **(weather or {}),
    }
    return {"location": place(name, lat, lon, **more), "current": weather}


COUNTRY_TEXTS = {
    "Chad": '[{"name":{"common":"Chad"},"continents":["Africa"],"timezones":["UTC+01:00"],'
            '"subregion":"Middle Africa","languages":{"ara":"Arabic","fra":"French"},"capital":["N\'Djamena"]}]',
    "Holland": '[{"name":{"common":"Netherlands"},"continents":["Europe"],"timezones":["UTC+01:00"],'
               '"subregion":"Western Europe","languages":{"nld":"Dutch"},"capital":["Amsterdam"]}]',
    "Netherlands": '[{"name":{"common":"Netherlands"},"continents":["Europe"],"timezones":["UTC+01:00"],'
                   '"subregion":"Western Europe","languages":{"nld":"Dutch"},"capital":["Amsterdam"]}]',
}
