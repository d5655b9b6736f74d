import random

import pytest

from smogline.functions.addresses import is_header
from smogline.operators.cities import fill_countries, joined_lines, normalise_cities
from smogline.plans.jobs import normalise_city_file
from smogline.sources.citylists import read_joined, read_lines, write_joined

LIST = """AUSTRIA
Graz
Bad Ischl
BOSNIA & HERZEGOVINA
Sarajevo
COTE D'IVOIRE
EMPTYLAND
ST. KITTS-NEVIS
Basseterre-West
St. Paul's"""

ENTRIES = (
    "Graz+AUSTRIA,Bad+Ischl+AUSTRIA,Sarajevo+BOSNIA+&+HERZEGOVINA,"
    "Basseterre-West+ST.+KITTS-NEVIS,St.+Paul's+ST.+KITTS-NEVIS"
)


def expected(lines):
    """The list by brute force."""
    country, found = None, []
    for line in lines:
        if line.upper() == line and line.lower() != line:
            country = line
        else:
            found.append("+".join(part.replace(" ", "+") for part in (line, country) if part is not None))
    return found


@pytest.fixture
def small_splits(spark):
    """Splits of a few lines each, so that lists span many of them."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def save(tmp_path, text, name="list.txt"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_sample_list(spark, tmp_path):
    entries = normalise_cities(read_lines(spark, save(tmp_path, LIST)))
    assert ",".join(row.entry for row in entries.orderBy("pos").collect()) == ENTRIES
    line = joined_lines(entries).first()
    assert (line.line_no, line.line, line.n_entries) == (0, ENTRIES, 5)


@pytest.mark.parametrize(
    ("line", "header"),
    [("PERU", True), ("ÉIRE 2", True), ("Peru", False), ("123", False), ("", False), ("&-.", False), ("straSSE", False)],
)
def test_header(spark, line, header):
    assert spark.createDataFrame([(line,)], "line STRING").select(is_header("line")).first()[0] is header


def test_many_splits_and_files(spark, tmp_path, small_splits):
    random.seed(3)
    lines = ["FIRST LAND"]
    for i in range(1500):
        # One country holds a third of the list and spans many splits.
        if i % 7 == 0 and not 500 < i < 1000:
            lines.append(f"LAND {i}")
        lines.append(f"City number {i}" if random.random() < 0.9 else f"c{i}")
    folder = tmp_path / "parts"
    folder.mkdir()
    for number, start in enumerate((0, 400, 1100)):
        end = (400, 1100, len(lines))[number]
        save(folder, "\n".join(lines[start:end]) + "\n", f"part-{number:05d}.txt")
    read = read_lines(spark, str(folder))
    assert read.select("file", "split_start").distinct().count() > 50
    filled = normalise_cities(read).orderBy("pos").collect()
    assert [row.entry for row in filled] == expected(lines)
    assert [row.pos for row in filled] == list(range(1500))
    pieces = joined_lines(normalise_cities(read), 64).orderBy("line_no").collect()
    assert ",".join(row.line for row in pieces) == ",".join(expected(lines))
    assert max(row.n_entries for row in pieces) == 64


def test_files_follow_each_other_by_name(spark, tmp_path):
    folder = tmp_path / "lists"
    folder.mkdir()
    save(folder, "FRANCE\nParis\n", "a_long_name.txt")
    save(folder, "Lyon\nSPAIN\nMadrid\n", "b.txt")
    rows = normalise_cities(read_lines(spark, str(folder))).orderBy("pos").collect()
    assert [row.entry for row in rows] == ["Paris+FRANCE", "Lyon+FRANCE", "Madrid+SPAIN"]


def test_parts_of_a_write_follow_their_numbers(spark, tmp_path):
    folder = tmp_path / "lists"
    folder.mkdir()
    for number in (99999, 100000, 7):
        save(folder, f"Town {number}\n", f"part-{number:05d}-x.txt")
    rows = normalise_cities(read_lines(spark, str(folder))).orderBy("pos").collect()
    assert [row.city for row in rows] == ["Town 7", "Town 99999", "Town 100000"]


def test_lines_of_another_system(spark, tmp_path):
    (tmp_path / "dos.txt").write_bytes(b"FRANCE\r\nParis\r\nLyon\r\n")
    rows = normalise_cities(read_lines(spark, str(tmp_path / "dos.txt"))).orderBy("pos").collect()
    assert [row.entry for row in rows] == ["Paris+FRANCE", "Lyon+FRANCE"]


def test_city_before_any_country(spark, tmp_path):
    rows = fill_countries(read_lines(spark, save(tmp_path, "Lost\nPERU\nLima"))).orderBy("pos").collect()
    assert [(row.city, row.country) for row in rows] == [("Lost", None), ("Lima", "PERU")]


def test_joined_file_round_trip(spark, tmp_path, small_splits):
    source, target = save(tmp_path, "\n".join(["LAND"] + [f"Town {i}" for i in range(300)])), str(tmp_path / "joined")
    back = normalise_city_file(spark, source, target)
    assert sorted(row.entry for row in back.collect()) == sorted(f"Town+{i}+LAND" for i in range(300))
    ordered = back.orderBy("file", "split_start", "row").collect()
    assert [row.entry for row in ordered] == [f"Town+{i}+LAND" for i in range(300)]


def test_joined_text_with_line_breaks_and_empty_entries(spark, tmp_path):
    path = save(tmp_path, "a+A,b\n+B,,c+C,,\n")
    rows = read_joined(spark, path).orderBy("file", "split_start", "row").collect()
    assert [row.entry for row in rows] == ["a+A", "b+B", "c+C"]


def test_written_list_is_one_comma_joined_text(spark, tmp_path):
    entries = spark.createDataFrame([(1, "b"), (0, "a"), (2, "c")], "pos INT, entry STRING").coalesce(1)
    write_joined(entries, "entry", "pos", str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(part.read_text() for part in parts) == "a,b,c,"
