"""The jobs a user runs, from source to table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from smogline.functions.coordinates import address_request, coordinate_request
from smogline.operators.cities import normalise_cities
from smogline.operators.dictionary import (
    Fetch,
    bad_responses,
    build_dictionary,
    distinct_coords,
    forward_geocode,
    lookup_keys,
    unknown_coords,
)
from smogline.operators.enrich import enrich
from smogline.operators.forecast import MALFORMED, REASON, accepted, parse_forecast, to_geo_columns, to_raw_columns
from smogline.operators.latest import last_write
from smogline.operators.sizes import broadcast_if_small
from smogline.schemas import ENRICHED_READINGS, GEO_DICTIONARY, RAW_READINGS, REJECTED_RESPONSES
from smogline.scratch import new_folder
from smogline.sources.citylists import read_joined, read_lines, write_joined
from smogline.sources.files import delete, exists, move
from smogline.sources.streams import file_stream, publish, publish_stream
from smogline.sources.tables import latest_version, read_version, replace_table

OUTBOX = "lat DOUBLE, lon DOUBLE, value STRING"


def raw_readings(messages: DataFrame, order: list[str]) -> DataFrame:
    """Batch form of the raw ingest: messages to the last reading per coordinates and time."""
    rows = accepted(to_raw_columns(parse_forecast(messages)))
    return RAW_READINGS.select_from(last_write(rows, RAW_READINGS.key, order))


def enriched_readings(messages: DataFrame, dictionary: DataFrame, order: list[str]) -> DataFrame:
    """Batch form of the enriched stream: messages to the last reading per city, country and time."""
    rows = accepted(enrich(to_geo_columns(parse_forecast(messages)), dictionary))
    return ENRICHED_READINGS.select_from(last_write(rows, ENRICHED_READINGS.key, order))


# Below a dictionary's root: the rejected responses of its versions.
REJECTED = "rejected"


def refresh_dictionary(
    readings: DataFrame, fetch: Fetch, root: str, version: int, parallelism: int | None = None
) -> DataFrame:
    """Look up every coordinate of the readings and replace the dictionary, and the table of rejected responses."""
    return _new_version(distinct_coords(readings), fetch, root, version, parallelism, None)


def extend_dictionary(
    readings: DataFrame,
    fetch: Fetch,
    root: str,
    version: int,
    parallelism: int | None = None,
    again: tuple[str, ...] = (MALFORMED,),
) -> DataFrame:
    """Look up only coordinates that the last version does not have, and merge the answers into a new version.

    A coordinate whose response was rejected is asked for again if the reason is
    one of ``again`` (what is malformed, or did not come, may be sound next time).
    Rows and rejects of the last version that are not replaced stay.
    """
    spark = readings.sparkSession
    last = latest_version(spark, root, below=version)
    if last is None:
        return refresh_dictionary(readings, fetch, root, version, parallelism)
    before = read_version(spark, GEO_DICTIONARY, root, last)
    rejects = rejected_responses(spark, root, last).filter(~F.col(REASON).isin(*again))
    known = before.select("latitude", "longitude").unionByName(rejects.select("latitude", "longitude"))
    return _new_version(unknown_coords(readings, known), fetch, root, version, parallelism, last)


def rejected_responses(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Responses of a dictionary version, by default the latest, that gave no entry, with the reason."""
    version = latest_version(spark, root) if version is None else version
    return read_version(spark, REJECTED_RESPONSES, f"{root}/{REJECTED}", version)


def _new_version(
    coords: DataFrame, fetch: Fetch, root: str, version: int, parallelism: int | None, last: int | None
) -> DataFrame:
    """Entries and rejects from one stored copy of the responses, merged into those of the last version."""
    spark = coords.sparkSession
    path = new_folder(spark, "responses")
    lookup_keys(coords, fetch, parallelism=parallelism).write.parquet(path)
    responses = spark.read.parquet(path)
    found, bad = build_dictionary(responses), bad_responses(responses)
    if last is not None:
        asked = responses.select("latitude", "longitude")
        found = read_version(spark, GEO_DICTIONARY, root, last).unionByName(found)
        old = rejected_responses(spark, root, last).join(broadcast_if_small(asked), ["latitude", "longitude"], "left_anti")
        bad = REJECTED_RESPONSES.select_from(old).unionByName(REJECTED_RESPONSES.select_from(bad))
    # Rejects first: the dictionary's own folder tells that a version is there.
    replace_table(bad, REJECTED_RESPONSES, f"{root}/{REJECTED}", version)
    replace_table(found, GEO_DICTIONARY, root, version)
    delete(spark, path)
    return read_version(spark, GEO_DICTIONARY, root, version)


def normalise_city_file(spark: SparkSession, source: str, target: str) -> DataFrame:
    """A list of countries and cities to one of comma-joined entries, written and read back."""
    write_joined(normalise_cities(read_lines(spark, source)), "entry", "pos", target)
    return read_joined(spark, target)


def locate_cities(entries: DataFrame, fetch: Fetch, template: str, parallelism: int | None = None) -> DataFrame:
    """Coordinates of each entry; ``fetch`` gets a ``request`` column made from the template."""
    asked = entries.select("entry", address_request("entry", template).alias("request"))
    return forward_geocode(lookup_keys(asked, fetch, parallelism=parallelism), "entry")


def fill_outbox(
    stations: DataFrame, fetch: Fetch, template: str, root: str, run: str, parallelism: int | None = None
) -> DataFrame:
    """Fetch one forecast per station into a run of the outbox; a run that is there is not fetched again.

    Answers are stored before anything is sent, and moved into the outbox as one
    folder, so tasks and jobs may be retried. Returns the run's rows: lat, lon,
    ``value`` (NULL where no answer came).
    """
    spark = stations.sparkSession
    place, staged = f"{root}/outbox/run={run}", f"{root}/staged/run={run}"
    if not exists(spark, place):
        asked = stations.select("lat", "lon", coordinate_request("lat", "lon", template).alias("request"))
        answers = lookup_keys(asked, fetch, "value", parallelism).select("lat", "lon", "value")
        answers.write.mode("overwrite").parquet(staged)
        move(spark, staged, place)
    return spark.read.schema(OUTBOX).parquet(place)


def send_outbox(spark: SparkSession, root: str, fmt: str, checkpoint: str, path: str | None = None, **options: str) -> StreamingQuery:
    """Send what is new in the outbox, each run once, and stop; a restart goes on where the last one stopped.

    A file sink gets every row exactly once. A broker gets the rows of a batch
    again if sending stopped within it; they carry their run for the receiver.
    """
    waiting = file_stream(spark, f"{root}/outbox", f"{OUTBOX}, run STRING").filter(F.col("value").isNotNull())
    return publish_stream(waiting, fmt, checkpoint, path, **options).trigger(availableNow=True).start()


def publish_forecasts(
    stations: DataFrame,
    fetch: Fetch,
    template: str,
    fmt: str,
    path: str | None = None,
    parallelism: int | None = None,
    **options: str,
) -> int:
    """Fetch one forecast per station and send the texts on; returns how many stations got no answer (NULL)."""
    asked = stations.select("lat", "lon", coordinate_request("lat", "lon", template).alias("request"))
    seen = Observation()
    answers = lookup_keys(asked, fetch, "value", parallelism).observe(seen, F.count_if(F.col("value").isNull()).alias("none"))
    publish(answers.filter(F.col("value").isNotNull()), fmt, path, **options)
    return seen.get["none"]
