"""The jobs from their arguments to their files."""

import pytest

from lakemark import jobs
from lakemark.session import SCALE_SETTINGS, tune
from lakemark.sources import versions

HEADER = ",".join(f'"h{i}"' for i in range(61))


def wide(name, code, *cells):
    padded = [*cells] + [""] * (57 - len(cells))
    return ",".join(f'"{c}"' for c in [name, "AA", "label", code, *padded])


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "events.csv").write_text(
        "country_txt,iyear,gname\nChad,1999,g\nChad,2000,Unknown\nPeru,2000,\nMali,2000,h\n"
    )
    (tmp_path / "wide.csv").write_text(
        "\n".join(
            [
                HEADER,
                wide("Chad", "EG.ELC.PETR.ZS", "1", "2"),
                wide("Peru, East", "EG.ELC.PETR.ZS"),
                wide("Chad", "MS.MIL.XPND.GD.ZS", "7"),
                wide("Mali", "OTHER.CODE", "9"),
            ]
        )
    )
    (tmp_path / "nations.csv").write_text(
        "id;name;size\n" + "".join(f"{i};{n};{i * 10}\n" for i, n in enumerate(
            ["Chad", "Peru", "Mali", "Cuba", "Laos", "Togo"]))
    )
    return tmp_path


@pytest.fixture
def run(spark, folder):
    def call(*args):
        jobs.run(spark, jobs.parser().parse_args([str(a) for a in args]))

    call("ingest", folder / "events.csv", folder / "collection")
    return call


def lines_of(spark, path):
    return [r[0] for r in spark.read.text(str(path)).collect()]


def documents(spark, path):
    return sorted(tuple(sorted(r.asDict().items())) for r in spark.read.json(str(path)).collect())


def test_listed_reports(spark, run, folder, capsys):
    events = ["--events", folder / "collection"]
    run("most-attacked-countries", *events, "--out", folder / "a")
    run("attacks-per-year", *events, "--out", folder / "b")
    run("claimed-attacks", *events, "--out", folder / "c")
    assert documents(spark, folder / "a") == [
        (("Countries", "[Chad]"), ("NumOfAttacks", 2)),
        (("Countries", "[Mali, Peru]"), ("NumOfAttacks", 1)),
    ]
    assert documents(spark, folder / "b") == [
        (("NumOfAttacks", 1), ("Years", "[1999]")),
        (("NumOfAttacks", 3), ("Years", "[2000]")),
    ]
    assert documents(spark, folder / "c") == [
        (("GroupName", "[]"), ("NumOfAttacks", 0)),
        (("GroupName", "[g, h]"), ("NumOfAttacks", 1)),
    ]
    assert "Chad" in capsys.readouterr().out


def test_indicator_reports(spark, run, folder):
    events = ["--events", folder / "collection"]
    run("attacks-energy", folder / "wide.csv", folder / "energy", *events)
    run("attacks-defense", folder / "wide.csv", folder / "defense", *events)
    run("attacks-energy", folder / "wide.csv", folder / "other", "--code", "OTHER.CODE", *events)
    assert lines_of(spark, folder / "energy") == ["(2,(Chad,1.5))", "(1,(Peru,0.0))"]
    assert lines_of(spark, folder / "defense") == ["(2,(Chad,7.0))"]
    assert lines_of(spark, folder / "other") == ["(1,(Mali,9.0))"]
    run("attacks-defense", folder / "wide.csv", folder / "docs", "--documents", *events)
    assert documents(spark, folder / "docs") == [
        (("Average expenditure for Defense", "7.0"), ("Country", "Chad"), ("NumOfAttacks", 2)),
    ]


def test_profile_then_join(spark, run, folder, capsys):
    metadata = ["--metadata", folder / "metadata"]
    run("profile", folder / "nations.csv", ";", *metadata)
    join = ["join", folder / "nations.csv", "nations", ";", *metadata]
    run(*join, "--events", folder / "collection", "--out", folder / "joined")
    assert documents(spark, folder / "joined")[0] == (
        ("country_txt", "Chad"), ("gname", "Unknown"), ("iyear", 2000), ("line", "0;Chad;0"),
    )
    assert len(documents(spark, folder / "joined")) == 4
    run(*join, "--events", folder / "collection", "--as-text")
    assert "[Chad, 1999, g]" in capsys.readouterr().out


def test_profile_documents_then_join(spark, run, folder):
    metadata = ["--metadata", folder / "documents", "--metadata-format", "json"]
    run("profile", folder / "nations.csv", ";", *metadata)
    assert sorted(lines_of(spark, folder / "documents" / "nations")) == [
        '{"Column Number":1,"Different Values":6}', '{"Key Column":1}',
    ]
    run("join", folder / "nations.csv", "nations", ";", *metadata,
        "--events", folder / "collection", "--out", folder / "joined")
    assert len(documents(spark, folder / "joined")) == 4


def test_profiles_of_two_files_in_one_place(spark, run, folder, capsys):
    """Each is joined by its own key; a name that was never profiled fails."""
    (folder / "sizes.csv").write_text(
        "name;id\n" + "".join(f"{n};{i}\n" for i, n in enumerate(["Chad", "Peru", "Mali", "Cuba", "Laos"]))
    )
    for form in ([], ["--metadata-format", "json"]):
        place = ["--metadata", folder / f"profiles{len(form)}", *form]
        for name in ("nations", "sizes"):
            run("profile", folder / f"{name}.csv", ";", *place)
        assert "different_values" in capsys.readouterr().out
        for name, line in (("nations", "0;Chad;0"), ("sizes", "Chad;0")):
            out = folder / f"joined-{name}{len(form)}"
            run("join", folder / f"{name}.csv", name, ";", *place, "--events", folder / "collection", "--out", out)
            found = [dict(d)["line"] for d in documents(spark, out)]
            assert len(found) == 4 and found.count(line) == 2
        shown = capsys.readouterr().out
        assert "0;Chad;0" in shown and "Unknown" in shown  # lines and events before the join
        with pytest.raises(Exception, match="no key column|PATH_NOT_FOUND"):
            run("join", folder / "nations.csv", "other", ";", *place, "--events", folder / "collection")


def test_reader_options(spark, run, folder):
    (folder / "latin.csv").write_bytes("id;name\n1;Perú\n2;Chad\n3;Mali\n4;Laos\n5;Togo\n".encode("latin-1"))
    (folder / "e.csv").write_bytes("country_txt,iyear\nPerú,1\n".encode("latin-1"))
    option = ["--lake-option", "encoding=ISO-8859-1"]
    run("ingest", folder / "e.csv", folder / "latin", "--schema", "country_txt STRING, iyear INT", "--csv-option", "encoding=ISO-8859-1")
    run("profile", folder / "latin.csv", ";", "--metadata", folder / "m", "--schema", "id INT, name STRING", *option)
    join = ["join", folder / "latin.csv", "latin", ";", "--metadata", folder / "m", "--events", folder / "latin", "--out", folder / "o", *option]
    with pytest.raises(ValueError, match="gname"):
        run(*join)
    run(*join, "--missing-fields", "null")
    assert [dict(d)["line"] for d in documents(spark, folder / "o")] == ["1;Perú"]


def test_events_as_documents_and_named_apart(spark, run, folder):
    lines = ['{"Land":"Chad","iyear":1}', '{"Land":"Chad","iyear":"2","gname":"g"}', '{"gname":null,"Land":"Peru"}']
    (folder / "d.json").write_text("\n".join(lines))
    events = ["--events", folder / "d.json", "--events-format", "documents"]
    with pytest.raises(ValueError, match="country_txt"):
        run("most-attacked-countries", *events, "--out", folder / "x")
    run("most-attacked-countries", *events, "--event-field", "country_txt=$.Land", "--out", folder / "x")
    assert documents(spark, folder / "x") == [
        (("Countries", "[Chad]"), ("NumOfAttacks", 2)), (("Countries", "[Peru]"), ("NumOfAttacks", 1)),
    ]
    run("profile", folder / "nations.csv", ";", "--metadata", folder / "m")
    run(
        "join", folder / "nations.csv", "nations", ";", "--metadata", folder / "m", *events, "--event-field", "country_txt=$.Land",
        "--as-text", "--out", folder / "j",
    )
    assert sorted(dict(d)["event"] for d in documents(spark, folder / "j")) == ["[Chad, 1]", "[Chad, 2, g]", "[null, Peru]"]


def test_ingest_keeps_versions(spark, run, folder):
    place = folder / "collection"
    run("ingest", folder / "events.csv", place)
    first, second = [r["version"] for r in versions(spark, str(place)).orderBy("number").collect()]
    for version in (first, second):
        run("attacks-per-year", "--events", place, "--events-version", version, "--out", folder / version)
    assert documents(spark, folder / first) == documents(spark, folder / second)
    run("ingest", folder / "events.csv", place, "--keep", 1)
    assert len(list((place / "versions").iterdir())) == 1


def test_report_layouts(spark, run, folder):
    events = ["--events", folder / "collection"]
    run("claimed-attacks", *events, "--out", folder / "long", "--parts", "0")
    assert len(documents(spark, folder / "long")) == 3
    run("attacks-energy", folder / "wide.csv", folder / "many", *events, "--many-files")
    assert sorted(lines_of(spark, folder / "many")) == ["(1,(Peru,0.0))", "(2,(Chad,1.5))"]


def test_bad_arguments():
    for args in (
        [], ["join", "lake", "name", "|", "--metadata", "m"], ["attacks-energy"], ["profile", "x"],
        ["no-such-job"],
        ["attacks-per-year", "--events-option", "novalue"],
    ):
        with pytest.raises(SystemExit):
            jobs.parser().parse_args(args)
    options = jobs.parser().parse_args(["attacks-per-year", "--events-option", "database=x=y"])
    assert dict(options.events_option) == {"database": "x=y"}


def test_missing_places():
    for args in (["attacks-energy", "wide.csv"], ["profile", "t.csv", ";"]):
        with pytest.raises(SystemExit):
            jobs.main(args)


def test_tuning_leaves_given_settings(spark):
    names = list(SCALE_SETTINGS)
    before = {name: spark.conf.get(name, None) for name in names}
    other = spark.newSession()
    tune(other)
    given = spark.sparkContext.getConf()
    for name in names:
        expected = given.get(name) if given.contains(name) else SCALE_SETTINGS[name]
        assert other.conf.get(name) == expected
    assert before == {name: spark.conf.get(name, None) for name in names}
