"""An index that takes new songs: segments, merged at read, compacted.

The reference fills its score table once; a new song changes the corpus size
and the frequencies, and with them every score. A segment stores only what
does not change: its songs, its postings (song, token, count) and its document
frequencies. Scores follow at read from the counts, the summed frequencies of
all segments and the summed number of songs, so adding songs costs work for the
new songs alone. ``compact`` merges the segments into one.

A segment is complete once its marker is written, after all its tables;
readers and later segments ignore the others, so a load that was lost midway
can be repeated under the same name. The marker names the segments that this
one replaces; these are ignored from then on, so a compaction takes effect at
once and its clean-up may be lost or repeated. A song that an earlier segment
holds is not added again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, file_system
from .index import doc_frequency, song_totals, tfidf, token_counts

_TABLES = ("song", "token", "dfreq")
_DONE = "complete"


def segments(spark: SparkSession, path: str) -> list[str]:
    """Paths of the complete segments that none replaces, by name."""
    fs, top = file_system(spark, path)
    if not fs.exists(top):
        return []
    found = sorted(str(s.getPath().toString()) for s in fs.listStatus(top) if s.isDirectory())
    done = [p for p in found if fs.exists(file_system(spark, f"{p}/{_DONE}/_SUCCESS")[1])]
    if not done:
        return []
    markers = spark.read.schema("replaces string").parquet(*[f"{p}/{_DONE}" for p in done])
    gone = {r["replaces"] for r in markers.distinct().collect()}  # names of segments
    return [p for p in done if p.rsplit("/", 1)[-1] not in gone]


def _table(spark: SparkSession, paths: list[str], name: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [spark.read.parquet(f"{p}/{name}") for p in paths])


def _write(spark: SparkSession, path: str, song: DataFrame, token: DataFrame, dfreq: DataFrame | None,
           replaces: tuple[str, ...] | list[str] = ()) -> str:
    song.write.mode("overwrite").parquet(f"{path}/song")
    token.write.mode("overwrite").parquet(f"{path}/token")
    dfreq = doc_frequency(spark.read.parquet(f"{path}/token")) if dfreq is None else dfreq
    dfreq.write.mode("overwrite").parquet(f"{path}/dfreq")
    spark.createDataFrame([(r,) for r in replaces], "replaces string").write.mode("overwrite").parquet(f"{path}/{_DONE}")
    return path


def add(path: str, name: str, songs: DataFrame, texts: DataFrame | None = None,
        tokens: DataFrame | None = None) -> str:
    """A new segment of ``songs`` (song_id first of its columns that matter)
    and their ``texts`` (song_id, text) or ``tokens`` (song_id, token, count).
    Songs without a row of ``songs`` have no postings."""
    spark, folder = songs.sparkSession, f"{path}/{name}"
    earlier = [p for p in segments(spark, path) if p.rsplit("/", 1)[-1] != name]
    if earlier:
        songs = songs.join(_table(spark, earlier, "song").select("song_id"), "song_id", "left_anti").select(*songs.columns)
    songs.write.mode("overwrite").parquet(f"{folder}/new")
    new = spark.read.parquet(f"{folder}/new")
    if texts is not None:
        tokens = token_counts(texts.join(new.select("song_id"), "song_id", "left_semi"))
    else:
        tokens = tokens.select("song_id", "token", "count").join(new.select("song_id"), "song_id", "left_semi")
    _write(spark, folder, new, tokens, None)
    delete_path(spark, f"{folder}/new")
    return folder


def open_segments(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(songs, tokens, frequencies) of all complete segments."""
    paths = segments(spark, path)
    if not paths:
        raise FileNotFoundError(f"no complete segment under {path}")
    frequencies = _table(spark, paths, "dfreq").groupBy("token").agg(F.sum("df").alias("df"))
    return _table(spark, paths, "song"), _table(spark, paths, "token"), frequencies


def scores(spark: SparkSession, path: str) -> DataFrame:
    """(song_id, token, score) over all segments, as of now."""
    songs, tokens, frequencies = open_segments(spark, path)
    return tfidf(tokens, songs, frequencies)


def totals(spark: SparkSession, path: str) -> DataFrame:
    return song_totals(scores(spark, path))


def compact(spark: SparkSession, path: str, name: str) -> str:
    """One segment ``name`` in place of all complete ones, which are deleted
    after it is complete."""
    old = segments(spark, path)
    if any(p.rsplit("/", 1)[-1] == name for p in old):
        raise ValueError(f"{name} exists")
    songs, tokens, frequencies = open_segments(spark, path)
    folder = _write(spark, f"{path}/{name}", songs, tokens, frequencies, [p.rsplit("/", 1)[-1] for p in old])
    for p in old:
        delete_path(spark, p)
    return folder
