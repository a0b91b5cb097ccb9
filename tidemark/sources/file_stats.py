"""Which files of a stored table may hold some keys.

For each data file the number of rows, the least and the greatest key and a Bloom filter
of its keys are stored beside the data, one small table a write. Keys are looked up by
ranges first, which decide most where files hold keys in order, and by the filters then,
which tell that a new key is in no file although it lies among theirs. A filter has
BITS_PER_ROW bits a row and is stored as 64-bit words, so that a look-up joins the few
words of its keys and reads no filter whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import versions
from tidemark.sources.versions import FILE, PART, Version

# Together about one key in 700 is taken for one of a file that does not hold it.
BITS_PER_ROW, HASHES = 16, 5


def write_stats(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    staged: dict[str, list[str]],
    keys: Sequence[str],
) -> None:
    """Describe the files of one write by their keys."""
    folders = [path for paths in staged.values() for path in paths]
    if not folders:
        return
    commit = folders[0].split("/")[0]
    paths = [versions.data_path(root, folder) for folder in folders]
    rows = versions.read_paths(spark, root, schema, paths, with_file=True)
    rows = rows.select(PART, FILE, *keys)
    of_files = rows.groupBy(PART, FILE).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(*keys)).alias("low"),
        F.max(F.struct(*keys)).alias("high"),
    )
    target = _path(root, commit, keys, "files")
    of_files.coalesce(1).write.parquet(target)
    sizes = _read(spark, [target], _files_schema(schema, keys))
    sized = rows.select(F.col(FILE).alias("_of"), *keys).join(
        sizes.select(FILE, "n"), F.col("_of") == F.col(FILE)
    )
    places = F.explode(_places(keys, F.col("n"))).alias("place")
    words = sized.select(FILE, places).select(FILE, *_word_and_bit())
    words.groupBy(FILE, "word").agg(F.bit_or("bit").alias("bits")).write.parquet(
        _path(root, commit, keys, "bits")
    )


def files_of(
    spark: SparkSession,
    root: str,
    version: Version,
    parts: Iterable[str],
    keys: Sequence[str],
) -> DataFrame:
    """The files of some parts of a version: PART, FILE, n, low, high.

    Files of writes that were not described are not among them.
    """
    paths = {path for part in parts for path in version.parts.get(part, ())}
    commits = sorted({path.split("/")[0] for path in paths})
    described = [c for c in commits if versions.complete(spark, _path(root, c, keys, "bits"))]
    listed = [_path(root, commit, keys, "files") for commit in described]
    schema = _files_schema(version.schema, keys)
    if not listed:
        return spark.createDataFrame([], schema)
    folder = F.regexp_extract(FILE, "^(.*)/[^/]*$", 1)
    live = F.col(FILE).isin(sorted(paths)) | folder.isin(sorted(paths))
    return _read(spark, listed, schema).filter(live)


def files_with(
    spark: SparkSession,
    root: str,
    version: Version,
    wanted: DataFrame,
    keys: Sequence[str],
    files: DataFrame,
) -> list[str]:
    """Files that may hold one of the keys of ``wanted`` (PART and the key columns)."""
    key = F.struct(*(F.col(f"_key_{k}").alias(k) for k in keys))
    asked = wanted.select(F.col(PART).alias("_part"), *(F.col(k).alias(f"_key_{k}") for k in keys))
    near = asked.join(files, F.col("_part") == F.col(PART)).filter(
        (key >= F.col("low")) & (key <= F.col("high"))
    )
    places = F.explode(_places([f"_key_{k}" for k in keys], F.col("n"))).alias("place")
    asked_words = near.select(FILE, key.alias("key"), places).select(FILE, "key", *_word_and_bit())
    commits = sorted({r[0].split("/")[0] for r in files.select(FILE).collect()})
    if not commits:
        return []
    bits = _read(
        spark,
        [_path(root, commit, keys, "bits") for commit in commits],
        f"{FILE} string, word long, bits long",
    ).select(F.col(FILE).alias("_of"), F.col("word").alias("_word"), "bits")
    same = (F.col(FILE) == F.col("_of")) & (F.col("word") == F.col("_word"))
    found = asked_words.join(bits, same).filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    sure = found.groupBy(FILE, "key").agg(F.count(F.lit(1)).alias("set_bits"))
    hit = sure.filter(F.col("set_bits") == HASHES).select(FILE).distinct()
    return sorted(r[0] for r in hit.collect())


def _places(keys: Sequence[str], n: Column) -> Column:
    """The bits of a key in the filter of a file with n rows."""
    size = n * BITS_PER_ROW
    return F.array(
        *(F.pmod(F.xxhash64(*map(F.col, keys), F.lit(i)), size) for i in range(HASHES))
    )


def _word_and_bit() -> list[Column]:
    place = F.col("place")
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    return [F.floor(place / 64).cast("long").alias("word"), bit.alias("bit")]


def _files_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    key = T.StructType([T.StructField(k, schema[k].dataType) for k in keys])
    return T.StructType(
        [
            T.StructField(PART, T.StringType()),
            T.StructField(FILE, T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("low", key),
            T.StructField("high", key),
        ]
    )


def _read(spark: SparkSession, paths: list[str], schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths)


def _path(root: str, commit: str, keys: Sequence[str], name: str = "") -> str:
    return f"{root.rstrip('/')}/stats/{commit}/{'-'.join(keys)}/{name}".rstrip("/")
