"""Loads with rejects."""

from sift.operators import loading
from sift.session import new_scratch_path


def _file(spark, lines):
    path = new_scratch_path(spark, "csv")
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)
    return path


def test_bad_rows_go_to_the_rejects(spark):
    out = new_scratch_path(spark, "loaded")
    artists = loading.load(spark, _file(spark, ["1,a", "2,b", "2,a2", "2,a2", ",none", "x,y", f"3,{'n' * 256}", f"4,{'n' * 255}"]),
                           "artist", out)
    assert sorted(map(tuple, artists.accepted.collect())) == [(1, "a"), (2, "a2"), (4, "n" * 255)]
    assert sorted((r.key, r.reason, r.copies) for r in artists.rejects.collect()) == [
        ("", "missing key", 1), ("2", "duplicate key", 2), ("3", "too long", 1), ("x", "bad value", 1)]
    songs = loading.load(spark, _file(spark, ['1,1,"s ""q"", t",/l', "2,3,s,/l", "3,,s,/l", "4,2", "5,2,s,/l,more", "6,z,s,/l",
                                              "7,2,,", "7,2,,"]), "song", out, artists.accepted)
    assert sorted(map(tuple, songs.accepted.collect())) == [
        (1, 1, 's "q", t', "/l"), (3, None, "s", "/l"), (7, 2, None, None)]
    assert sorted((r.key, r.reason, r.copies) for r in songs.rejects.collect()) == [
        ("2", "orphan", 1), ("4", "bad row", 1), ("5", "bad row", 1), ("6", "bad value", 1), ("7", "duplicate key", 1)]


def test_an_empty_file(spark):
    found = loading.load(spark, _file(spark, []), "token", new_scratch_path(spark, "loaded"))
    assert found.accepted.collect() == [] and found.rejects.collect() == []
