"""Known licence texts inside longer documents, and known texts read from a folder (operator 9)."""

import duckdb
import pytest

from ratewise.llm import catalog, licenses

SCHEMA = "doc_id bigint, text string, digest string, found string"
HEAD = "README\n\nA tool.\n\n"
TAIL = "\n\nimport os\n\n\nimport re"


def table(spark, docs):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)


def scanned(df, **more):
    return {r.doc_id: (r.licenses, r.text_license) for r in licenses.scan_licenses(df, **more).collect()}


@pytest.fixture(scope="module")
def texts():
    several = [(name, text) for name, text in licenses.KNOWN if "\n\n" in text]
    inside = [(i, f"{HEAD}Copyright (c) 2019 A. Body\n\n{text}{TAIL}") for i, (_, text) in enumerate(several)]
    entire = [(100 + i, f"Copyright 2001 Them\r\n \r\n{text.upper()}") for i, (_, text) in enumerate(licenses.KNOWN)]
    cut = [(200 + i, HEAD + text.rsplit(" ", 1)[0] + TAIL) for i, (_, text) in enumerate(several)]
    return several, inside + entire + cut + [(300, None), (301, ""), (302, "\n\n\n"), (303, licenses.MIT + TAIL), (303, licenses.MIT + TAIL)]


def test_each_known_text_is_found(spark, texts):
    several, docs = texts
    out = scanned(table(spark, docs), runs=True)
    assert len(several) >= 7
    for i, (name, _) in enumerate(several):
        assert out[i] == (name, None)
        assert name not in out[200 + i][0].split(",")
    for i, (name, _) in enumerate(licenses.KNOWN):
        assert out[100 + i][1] == name and name in out[100 + i][0].split(",")
    assert out[300] == out[301] == out[302] == ("", None) and out[303] == ("MIT", None)


def test_title_lines_are_left_out(spark):
    docs = [(1, "BSD 3-Clause License\n\n" + licenses.BSD_CONDITIONS + licenses.BSD_ENDORSEMENT + licenses.BSD_DISCLAIMER),
            (2, "The MIT License (MIT)\n" + licenses.MIT), (3, "zlib License"), (4, "the MIT license text\n" + licenses.MIT)]
    assert scanned(table(spark, docs), runs=True) == {1: ("BSD-3-Clause", "BSD-3-Clause"), 2: ("MIT", "MIT"), 3: ("", None), 4: ("", None)}


def test_sql_of_runs(spark, texts):
    _, docs = texts
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    columns = ("doc_id", "n_units", "n_matched", "licenses", "text_license")
    got = licenses.scan_licenses(table(spark, docs), runs=True).select(*columns).collect()
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()['op9_license_scan']})").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_known_texts_of_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("Copyright 2020 Us\n\nUse it well.\n\nShare it.\n")
    (tmp_path / "Own-2.0.txt").write_text("Use it as you like.")
    (tmp_path / "Blank.txt").write_text("\n\n")
    known = licenses.known_from(spark, str(tmp_path))
    docs = [(1, "x\n\nuse it WELL\n\nshare it\n\ny"), (2, "a\nUse it, as you like\nb"), (3, "Share it.\n\nUse it well."), (4, None), (5, licenses.MIT)]
    want = {1: ("Own-1.0", None), 2: ("Own-2.0", None), 3: ("", None), 4: ("", None), 5: ("", None)}
    assert scanned(table(spark, docs), known=known, runs=True) == want
    assert scanned(table(spark, docs), known=known)[1] == ("", None)
    assert licenses.scan_licenses(table(spark, docs).limit(0), known, runs=True).count() == 0
