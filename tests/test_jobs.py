"""The ten text jobs on the reference's fixture files, compared line by line with the goldens."""

import pytest
from test_agg import PAIRS, TOKEN_LINES
from test_joins import CITIES, G3, KEYS, RECORDS, STATIONS, USERS

from quern.plans import jobs


def _write(path, lines):
    path.write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)


def _out(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


@pytest.fixture()
def files(tmp_path):
    d = tmp_path / "join"
    d.mkdir()
    _write(d / "left_table.txt", ["\t".join(r) for r in CITIES])
    _write(d / "right_table.txt", ["  ".join(r) for r in USERS])
    _write(d / "join_key.txt", KEYS)
    return {
        "tokens": _write(tmp_path / "tokens.txt", TOKEN_LINES),
        "pairs": _write(tmp_path / "pairs.txt", [f"{a} {b}" for a, b in PAIRS]),
        "glob": str(d / "*.txt"),
        "left": str(d / "left_table.txt"),
        "right": str(d / "right_table.txt"),
        "keys": str(d / "join_key.txt"),
        "stations": _write(tmp_path / "station.txt", [f"{a} {b}" for a, b in STATIONS]),
        "records": _write(tmp_path / "record.txt", [" ".join(r) for r in RECORDS]),
        "tmp": tmp_path,
    }


G3_LINES = sorted("\t".join(r) for r in G3)


def test_word_counts(spark, files):
    out = str(files["tmp"] / "wc")
    jobs.word_count(spark, files["tokens"], out)
    assert _out(spark, out) == sorted(["apache\t1", "dataframe\t1", "map\t1", "mapreduce\t1", "reduce\t1",
                                       "spark\t3", "sql\t1", "streaming\t2", "structured\t1"])
    parts = sorted((files["tmp"] / "wc").glob("part-*"))
    assert len(parts) == 2
    seen = set()
    for part in parts:                      # O5: each file key-sorted, each key in one file
        keys = [line.split("\t")[0] for line in part.read_text(encoding="utf-8").splitlines()]
        assert keys == sorted(keys) and not (seen & set(keys))
        seen |= set(keys)
    out2 = str(files["tmp"] / "wc2")
    jobs.space_word_count(spark, files["tokens"], out2)
    assert _out(spark, out2) == _out(spark, out)
    with pytest.raises(Exception):
        jobs.space_word_count(spark, files["tokens"], out2)


def test_pair_jobs(spark, files):
    out = jobs.sort_pairs(spark, files["pairs"]).collect()
    assert [r.first_num for r in out] == [1, 2, 2, 3, 3, 3]
    coded = [tuple(r) for r in jobs.group_pairs(spark, files["pairs"]).collect()]
    assert coded == [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3)]
    meant = [tuple(r) for r in jobs.group_pairs(spark, files["pairs"], as_coded=False).collect()]
    assert meant == [(1, 1), (2, 1), (3, 1)]
    runs = sorted(tuple(r) for r in jobs.first_pair_per_group(spark, files["pairs"]).collect())
    assert runs == [(1, 1), (2, 2), (3, 1)]
    firsts = sorted(tuple(r) for r in jobs.first_pair_per_group(spark, files["pairs"], as_coded=False).collect())
    assert firsts == [(1, 1), (2, 1), (3, 1)]


def test_reduce_side_join_g4(spark, files):
    out = str(files["tmp"] / "rsj")
    jobs.reduce_side_join(spark, files["glob"], out)
    unmatched = sorted("\t".join(r) + "\tnull" for r in CITIES if r[0] in {"0", "5", "6", "7", "8", "9"})
    assert _out(spark, out) == sorted(G3_LINES + unmatched)


def test_map_side_join_g3(spark, files):
    out = str(files["tmp"] / "msj")
    jobs.map_side_join(spark, files["left"], files["right"], out)
    assert _out(spark, out) == G3_LINES


def test_semi_join_g3(spark, files):
    out = str(files["tmp"] / "semi")
    jobs.semi_join(spark, files["glob"], files["keys"], out)
    assert _out(spark, out) == G3_LINES


def test_bloom_join_g5(spark, files):
    out = str(files["tmp"] / "bloom")
    jobs.bloom_filter_join(spark, files["glob"], files["keys"], out)
    assert _out(spark, out) == sorted("\t".join((g[0], g[1], g[2], g[6], g[7])) for g in G3)


def test_secondary_sort_g7(spark, files):
    out = str(files["tmp"] / "ss")
    jobs.secondary_sort_join(spark, files["stations"], files["records"], out)
    names = dict(STATIONS)
    assert _out(spark, out) == sorted(f"{s}\t{names[s]}\t{d}\t{t}" for s, d, t in RECORDS)


def test_map_side_edge_rows(spark, tmp_path):
    left = _write(tmp_path / "left_table.txt", ["1 n 1 901 1 x", "1 m 1 901 1"])
    right = _write(tmp_path / "right_table.txt", ["1 2G 123 1 ", " 2G 123 1", ""])
    got = sorted(tuple(r) for r in jobs.map_side_join(spark, left, right).collect())
    # Last city row wins; "1 " finds no city; the leading blank makes an empty userID.
    assert got == [("1", "m", "1", "901", "1", "", "2G", "123")]
    (tmp_path / "l2").mkdir()
    left2 = _write(tmp_path / "l2" / "left_table.txt", ["1 n 1 901 1 x"])
    got2 = sorted(tuple(r) for r in jobs.map_side_join(spark, left2, right).collect())
    assert got2 == [("1", "n", "1", "901", "1 x", "", "2G", "123")]


def test_command_line(spark, files):
    from quern.__main__ import main

    out = str(files["tmp"] / "cli_semi")
    main(["semi_join", files["glob"], files["keys"], out])
    assert _out(spark, out) == G3_LINES
    with pytest.raises(SystemExit):
        main(["semi_join", files["glob"], out])
