"""Hand-made payloads and small helpers."""

import json

PLACE = {"latitude": 47.25, "longitude": 15.5}
NAMES = ("PM", "NO2", "PM10", "PM2_5", "O3", "overall")


def forecast(latitude=47.25, longitude=15.5, timestamp=1700000000, base=11, without=(), **more):
    pollutants = {
        name: {"value_upm": base + i + 0.5, "pi": base + i, "aqi": base + i + 1, "aqi_cn": base + i + 2}
        for i, name in enumerate(NAMES)
        if name not in without
    }
    hours = [{"timestamp": timestamp, "avg": pollutants}, {"timestamp": timestamp + 3600, "avg": {}}]
    return json.dumps({"latitude": latitude, "longitude": longitude, "hourly": hours} | more)


def result(address, *types, lat=1.5, lng=2.5):
    return {
        "types": list(types),
        "formatted_address": address,
        "geometry": {"location": {"lat": lat, "lng": lng}, "location_type": "APPROXIMATE"},
    }


def response(*results):
    return json.dumps({"results": list(results), "status": "OK"})


def plan(df):
    """The physical plan as text."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
