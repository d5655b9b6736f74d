"""Manifests, removal of what none names, and plans over settled buckets."""

import shutil
import time

import pytest

from smogline.schemas import RAW_READINGS
from smogline.sources import files, keyed, manifest
from tests.samples import forecast, plan
from tests.test_keyed import batch, view


def grown(spark, root, batches=5, stations=6, buckets=4):
    keyed.create_log(spark, RAW_READINGS, root, buckets)
    for number in range(batches):
        rows = [(10 * number + i, forecast(float(i), base=10 * number + i)) for i in range(number % 3, stations)]
        keyed.write_batch(batch(spark, *rows, (9, "{bad")), RAW_READINGS, root, number)


def folders(tmp_path, name):
    place = tmp_path / name
    return sorted(path.name for path in place.iterdir() if path.is_dir()) if place.exists() else []


def test_numbers_become_ranges():
    assert manifest.ranges([3, 1, 2, 7, 7, 9]) == ((1, 3), (7, 7), (9, 9))
    found = manifest.Manifest(4, ((0, 2), (5, 5)), 3, {7: 1, 6: 1, 8: 3}, 16)
    assert found.batch_ids() == [0, 1, 2, 5] and found.generations() == {1: [6, 7], 3: [8]}
    assert manifest.Manifest.parse(4, found.text()) == found


def test_writers_do_not_lose_each_others_changes(spark, tmp_path):
    root = str(tmp_path)
    add = lambda n: lambda m: manifest.Manifest(batches=manifest.ranges([*m.batch_ids(), n]))
    first = manifest.commit(spark, root, manifest.Manifest, add(1))
    # Another writer takes the next number before the hint is moved; a third one's file is cut off.
    assert files.write_text(spark, manifest._path(root, first.number + 1), add(2)(first).text())
    assert files.write_text(spark, manifest._path(root, first.number + 2), '{"batches"')
    assert manifest.latest(spark, root).batch_ids() == [1, 2]
    last = manifest.commit(spark, root, manifest.Manifest, add(3))
    assert (last.number, last.batch_ids()) == (first.number + 3, [1, 2, 3])
    assert manifest.commit(spark, root, manifest.Manifest, lambda m: m).number == last.number
    (tmp_path / "manifest/last").unlink()
    assert manifest.latest(spark, root) == last


def test_expiry_keeps_the_view_the_rejects_and_a_replay(spark, tmp_path):
    root = str(tmp_path)
    grown(spark, root)
    before = view(spark, root)
    keyed.compact(spark, RAW_READINGS, root)
    keyed.expire(spark, root, grace_seconds=0)
    assert view(spark, root) == before
    assert keyed.quarantine(spark, RAW_READINGS, root).count() == 5
    accepted = sorted(path.parent.name for path in (tmp_path / "log").glob("*/outcome=accepted"))
    assert accepted == ["batch_id=-1", "batch_id=4"]
    rows = [(10 * 4 + i, forecast(float(i), base=40 + i)) for i in range(1, 6)]
    keyed.write_batch(batch(spark, *rows, (9, "{bad")), RAW_READINGS, root, 4)
    assert view(spark, root) == before
    # Later generations make earlier ones useless, by slices or as a whole.
    keyed.write_batch(batch(spark, (99, forecast(0.0, base=77))), RAW_READINGS, root, 5)
    keyed.compact(spark, RAW_READINGS, root)
    assert folders(tmp_path, "settled") == ["upto=3", "upto=4"]
    keyed.expire(spark, root, grace_seconds=0)
    assert folders(tmp_path, "settled") == ["upto=4"]
    assert view(spark, root) == before | {(0.0, 1700000000): 77.0}
    keyed.expire(spark, root, grace_seconds=0)
    assert len(manifest.numbers(spark, root)) == 1


def test_readers_go_on_under_a_lease_or_within_the_grace_period(spark, tmp_path):
    for name, options in (("leased", {"lease_seconds": 600}), ("recent", {})):
        root = str(tmp_path / name)
        grown(spark, root)
        opened = keyed.current_view(spark, RAW_READINGS, root, **options)
        keyed.compact(spark, RAW_READINGS, root)
        keyed.expire(spark, root, grace_seconds=0 if options else 600)
        assert opened.count() == 6
    # A lease that has run out holds nothing.
    root = str(tmp_path / "out")
    grown(spark, root)
    keyed.current_view(spark, RAW_READINGS, root, lease_seconds=0.01)
    time.sleep(0.05)
    keyed.compact(spark, RAW_READINGS, root)
    keyed.expire(spark, root, grace_seconds=0)
    assert not list((tmp_path / "out/leases").glob("*.json")) and len(list((tmp_path / "out/log").glob("*/outcome=accepted"))) == 2


def test_a_log_of_ten_thousand_batches(spark, tmp_path):
    """Views open what the manifest names and list nothing else; expiry leaves rejects alone."""
    root = str(tmp_path)
    grown(spark, root, batches=1)
    for number in range(1, 10_000):
        outcome = "accepted" if number % 100 else "rejected"
        shutil.copytree(tmp_path / f"log/batch_id=0/outcome={outcome}", tmp_path / f"log/batch_id={number}/outcome={outcome}")
    manifest.commit(spark, root, manifest.Manifest, lambda found: manifest.Manifest(batches=((-1, 9_999),), buckets=4))
    assert len(manifest.latest(spark, root).text()) < 100
    # As after a compaction of all but the last ones.
    keyed._write_generation(
        spark, keyed.read_log(spark, RAW_READINGS, f"{root}").filter("batch_id = 0 and outcome = 'accepted'").withColumn("slice", keyed._slice(RAW_READINGS)).drop("reject_reason", "payload", "batch_id", "outcome"),
        RAW_READINGS, f"{root}/settled/upto=9997", 4,
    )
    slices = {1700000000 // 86_400: 9_997}
    manifest.commit(spark, root, manifest.Manifest, lambda found: manifest.Manifest(batches=((9_998, 9_999),), upto=9_997, slices=slices, buckets=4))
    start = time.time()
    shown = keyed.current_view(spark, RAW_READINGS, root)
    assert time.time() - start < 5
    scanned = [line for line in plan(shown).splitlines() if line.startswith("Location")]
    assert scanned and not any("log]" in line for line in scanned)
    before = view(spark, root)
    keyed.expire(spark, root, grace_seconds=0)
    left = folders(tmp_path, "log")
    assert len(left) == 1 + 99 + 2 + 1 and view(spark, root) == before
    assert keyed.quarantine(spark, RAW_READINGS, root).count() == 100


def ancestors(text, leaf):
    """Lines of the nodes above each leaf of a formatted plan's tree."""
    found, above = [], []
    for line in text.split("\n\n")[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, name) for d, name in above if d < depth]
        if leaf in line:
            found.append([name for _, name in above])
        above.append((depth, line.strip(" :+-")))
    return found


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_settled_rows_do_not_move(spark, tmp_path, broadcast):
    root = str(tmp_path)
    grown(spark, root)
    keyed.compact(spark, RAW_READINGS, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        text = plan(keyed.current_view(spark, RAW_READINGS, root))
        above = ancestors(text, "smogline_")
        assert len(above) >= 2 and not any("Exchange" in name for names in above for name in names), text
        found = manifest.latest(spark, root)
        settled = keyed._settled(spark, RAW_READINGS, root, found)
        merged = keyed._last_writes(spark, settled, keyed._later(spark, RAW_READINGS, root, found.batch_ids()), RAW_READINGS)
        assert not any("Exchange" in name for names in ancestors(plan(merged), "smogline_") for name in names)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_slices_of_several_generations_keep_their_buckets(spark, tmp_path):
    root = str(tmp_path)
    keyed.create_log(spark, RAW_READINGS, root, 4)
    day = 86_400
    for number in range(4):
        rows = [(i, forecast(float(i), timestamp=day * (100 + number), base=number)) for i in range(9)]
        keyed.write_batch(batch(spark, *rows), RAW_READINGS, root, number)
        keyed.compact(spark, RAW_READINGS, root)
    assert len(manifest.latest(spark, root).generations()) == 3
    shown = keyed.current_view(spark, RAW_READINGS, root)
    above = ancestors(plan(shown), "smogline_")
    assert len(above) == 6 and not any("Exchange" in name for names in above for name in names), plan(shown).split("\n\n")[0]
    assert shown.count() == 36
    late = [(5, forecast(3.0, timestamp=day * 101, base=50)), (-1, forecast(4.0, timestamp=day * 101, base=60))]
    keyed.write_batch(batch(spark, *late), RAW_READINGS, root, 4)
    rows = {(row.latitude, row.timestamp // day): row.pm_data.pi for row in keyed.current_view(spark, RAW_READINGS, root).collect()}
    assert len(rows) == 36 and rows[3.0, 101] == 50.0 and rows[4.0, 101] == 1.0


def test_many_later_rows_are_sorted_and_few_hashed(spark, tmp_path):
    """A hash table of later rows must fit in a task's memory, whatever their number; sorted rows may spill."""
    root = str(tmp_path)
    keyed.create_log(spark, RAW_READINGS, root, 1)

    def write(first, last, number):
        kinds = RAW_READINGS.columns
        given = {"latitude": "CAST(id AS DOUBLE)", "longitude": "0.0D", "timestamp": "1700000000L"}
        values = f"CAST(named_struct('value_upm', NULL, 'pi', {number}, 'aqi', NULL, 'aqi_cn', NULL) AS {kinds['pm_data']})"
        columns = [f"{given.get(name, values)} AS {name}" for name in kinds]
        keyed.write_rows(spark.range(first, last).selectExpr(*columns), RAW_READINGS, root, number)

    def shown(joins, no_joins):
        rows = keyed.current_view(spark, RAW_READINGS, root)
        above = ancestors(plan(rows), "smogline_")
        assert len(above) >= 2 and not any("Exchange" in name for names in above for name in names), plan(rows)
        assert joins in plan(rows) and no_joins not in plan(rows)
        return {row["pi"]: row["count"] for row in rows.groupBy("pm_data.pi").count().collect()}

    write(0, 50_000, 0)
    write(20_000, 200_000, 1)
    keyed.compact(spark, RAW_READINGS, root)
    assert shown("SortMergeJoin", "ShuffledHashJoin") == {0.0: 20_000, 1.0: 180_000}
    write(199_990, 200_010, 2)
    keyed.compact(spark, RAW_READINGS, root)
    assert shown("ShuffledHashJoin", "SortMergeJoin") == {0.0: 20_000, 1.0: 179_990, 2.0: 20}
