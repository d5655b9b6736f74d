"""The coordinate dictionary: keys to look up, responses to parse, one entry per key."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogline.functions.addresses import city_of, country_of
from smogline.functions.coordinates import coord_key
from smogline.operators.forecast import INCOMPLETE, MALFORMED, REASON, parse_json
from smogline.operators.latest import last_write
from smogline.operators.sizes import MAX_BROADCAST_BYTES, broadcast_if_small
from smogline.schemas import CORRUPT, FORWARD_GEOCODE, GEO_DICTIONARY, GEOCODE, LOCALITY_TYPE

Fetch = Callable[[pd.DataFrame], pd.Series]


def distinct_coords(readings: DataFrame) -> DataFrame:
    """Coordinates to look up: one row each, however many readings they have."""
    return readings.select("latitude", "longitude").distinct()


def lookup_keys(keys: DataFrame, fetch: Fetch, column: str = "response", parallelism: int | None = None) -> DataFrame:
    """Add a text column that ``fetch`` fills, one Arrow batch of keys at a time.

    ``fetch`` runs on executors and maps a batch of keys to as many texts, in
    the same order; another number of texts is an error. It may run again for the same keys when a task is retried. ``parallelism``
    spreads few keys over many tasks when the wait is for a remote service.
    """
    schema = T.StructType([*keys.schema.fields, T.StructField(column, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(fetch(batch))
            if len(texts) != len(batch):
                raise ValueError(f"{len(texts)} texts came back for {len(batch)} keys")
            yield batch.assign(**{column: texts})

    spread = keys.repartition(parallelism) if parallelism else keys
    return spread.mapInPandas(run, schema)


@dataclass(frozen=True)
class Limits:
    """How a service may be asked by one task: requests at a time and for each second, tries, and seconds for an answer."""

    at_once: int = 8
    per_second: float | None = None
    tries: int = 3
    seconds: float = 30.0
    pause: float = 0.5


class _Pace:
    """Lets one request go every so many seconds, whoever asks."""

    def __init__(self, per_second: float | None):
        self.gap = 1 / per_second if per_second else 0.0
        self.next, self.lock = 0.0, threading.Lock()

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            at = max(time.monotonic(), self.next)
            self.next = at + self.gap
        time.sleep(max(0.0, at - time.monotonic()))


NO_ANSWER = "no_answer"
TOO_LATE = "too_late"


def lookup_each(
    keys: DataFrame,
    ask: Callable[[dict], str | None],
    column: str = "response",
    limits: Limits = Limits(),
    parallelism: int | None = None,
) -> DataFrame:
    """Add ``column`` and ``<column>_failure``: what ``ask`` answers for each row, or why there is no answer.

    Several rows are asked for at a time, in threads, at the pace of ``limits``;
    an error is tried again after a pause that doubles. A row whose tries all
    failed, or that took longer than allowed in all, has NULL and a reason
    (``failed: <error>``, ``no_answer``, ``too_late``); the others are not
    disturbed, and no row fails the job. Rows keep their order.
    """
    failure = f"{column}_failure"
    schema = T.StructType([*keys.schema.fields, T.StructField(column, T.StringType()), T.StructField(failure, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = _Pace(limits.per_second)

        def answer(row: dict, until: float) -> tuple[str | None, str | None]:
            reason = None
            for attempt in range(limits.tries):
                if attempt:
                    time.sleep(min(limits.pause * 2 ** (attempt - 1), max(0.0, until - time.monotonic())))
                if time.monotonic() >= until:
                    return None, TOO_LATE
                pace.wait()
                try:
                    text = ask(row)
                except Exception as error:  # whatever the caller's function raises is this row's failure
                    reason = f"failed: {error}"
                    continue
                return (None, NO_ANSWER) if text is None else (text, None)
            return None, reason

        # Not awaited at the end: a request that hangs must not hold the task.
        pool = ThreadPoolExecutor(limits.at_once)
        try:
            for batch in batches:
                rows = batch.to_dict("records")
                found = []
                # As many in hand as run at once, so that waiting for a place does not count as time for an answer.
                for at in range(0, len(rows), limits.at_once):
                    until = time.monotonic() + limits.seconds
                    asked = [pool.submit(answer, row, until) for row in rows[at : at + limits.at_once]]
                    found += [_awaited(future, until) for future in asked]
                    if any(reason == TOO_LATE for _, reason in found[at:]):
                        pool.shutdown(wait=False, cancel_futures=True)
                        pool = ThreadPoolExecutor(limits.at_once)
                yield batch.assign(**{column: [text for text, _ in found], failure: [reason for _, reason in found]})
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    spread = keys.repartition(parallelism) if parallelism else keys
    return spread.mapInPandas(run, schema)


def _awaited(future: Future, until: float) -> tuple[str | None, str | None]:
    try:
        return future.result(max(0.0, until - time.monotonic()))
    except TimeoutError:
        return None, TOO_LATE


def unknown_coords(readings: DataFrame, known: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Coordinates of the readings that are not among the known ones; these are broadcast if measured to fit."""
    coords = known.select("latitude", "longitude").distinct()
    return distinct_coords(readings).join(broadcast_if_small(coords, max_broadcast_bytes), ["latitude", "longitude"], "left_anti")


def lookup_saved(keys: DataFrame, responses: DataFrame, on: list[str]) -> DataFrame:
    """Add saved responses to keys; a key without one gets NULL."""
    return keys.join(responses, on, "left")


def parse_responses(responses: DataFrame, text: str = "response") -> DataFrame:
    """Coordinates, text, ``localities`` and ``reject_reason`` of each response.

    Localities are the results of that type with an address, and their positions.
    A response has at least one of them or a reason, never both.
    """
    parsed = parse_json(responses, text, GEOCODE, ["latitude", "longitude", text])
    placed = F.transform("results", lambda result, pos: F.struct(pos.alias("result_pos"), result.alias("result")))
    towns = F.filter(placed, lambda at: F.coalesce(F.array_contains(at.result.types, LOCALITY_TYPE), F.lit(False)))
    found = parsed.select("latitude", "longitude", text, CORRUPT, "results", towns.alias("towns"))
    named = F.filter("towns", lambda at: at.result.formatted_address.isNotNull())
    reason = (
        F.when(F.col(CORRUPT).isNotNull() | F.col("results").isNull(), MALFORMED)
        .when(F.col("latitude").isNull() | F.col("longitude").isNull(), INCOMPLETE)
        .when(F.size("towns") == 0, "no_locality")
        .when(F.size(named) == 0, "no_address")
    )
    return found.select("latitude", "longitude", text, named.alias("localities"), reason.alias(REASON))


def geocode_results(responses: DataFrame, text: str = "response", trim: bool = True) -> DataFrame:
    """One row per result of type locality of the accepted responses, with its position among the results.

    Several such results of one response stay; see ``build_dictionary``.
    """
    accepted = parse_responses(responses, text).filter(F.col(REASON).isNull())
    localities = accepted.select("latitude", "longitude", text, F.inline("localities")).select(
        "latitude",
        "longitude",
        "result_pos",
        F.col("result.formatted_address").alias("locality"),
        F.col("result.geometry").alias("geometry"),
        F.col(text).alias("rawgeo"),
    )
    named = localities.withColumns({"city": city_of("locality"), "country": country_of("locality", trim)})
    return GEO_DICTIONARY.select_from(named, "result_pos")


def bad_responses(responses: DataFrame, text: str = "response") -> DataFrame:
    """The other responses: not readable, without key, or without a locality that has an address."""
    rejected = parse_responses(responses, text).filter(F.col(REASON).isNotNull())
    return rejected.select("latitude", "longitude", F.col(text).alias("payload"), REASON)


def build_dictionary(responses: DataFrame, text: str = "response", trim: bool = True) -> DataFrame:
    """Dictionary rows, one per coordinate: the last locality of a response wins."""
    found = geocode_results(responses, text, trim)
    return GEO_DICTIONARY.select_from(last_write(found, GEO_DICTIONARY.key, ["result_pos", "rawgeo"]))


def by_rounded_key(dictionary: DataFrame) -> DataFrame:
    """City and country per rounded coordinate; the greatest exact coordinate wins a shared key."""
    keyed = dictionary.select(
        coord_key("latitude").alias("lat_key"),
        coord_key("longitude").alias("lon_key"),
        F.struct("latitude", "longitude").alias("place"),
        F.struct("city", "country").alias("name"),
    )
    known = keyed.filter(F.col("lat_key").isNotNull() & F.col("lon_key").isNotNull())
    return known.groupBy("lat_key", "lon_key").agg(F.max_by("name", "place").alias("name")).select(
        "lat_key", "lon_key", "name.*"
    )


def forward_geocode(responses: DataFrame, address: str = "address", text: str = "response") -> DataFrame:
    """Address with latitude and longitude of the first result; NULL when there is none."""
    parsed = parse_json(responses, text, FORWARD_GEOCODE, [address])
    location = F.get("results", 0).geometry.location
    return parsed.select(address, location.lat.alias("lat"), location.lng.alias("lon"))
