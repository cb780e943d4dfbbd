"""Reading the Parquet layers and finding source files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_NAMES = ("train_{}.txt", "test_{}.txt", "RUL_{}.txt")


def _file_system(spark: SparkSession, path: str):
    """The Hadoop path and the file system it is on."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as the machines' own file system knows it; None if it lies elsewhere."""
    place, system = _file_system(spark, path)
    return place.toUri().getPath() if system.getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system; nothing is listed."""
    place, system = _file_system(spark, path)
    return system.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    place, system = _file_system(spark, path)
    system.delete(place, True)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file, making the folders above its new name."""
    place, system = _file_system(spark, target)
    system.mkdirs(place.getParent())
    system.rename(_file_system(spark, path)[0], place)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, sorted; none if it is missing."""
    if not path_exists(spark, path):
        return []
    place, system = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place))


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of the file system, hidden ones included."""
    place, system = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in system.globStatus(place) or ())


def size_of(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of files and folders together."""
    return sum(system.getContentSummary(place).getLength() for place, system in (_file_system(spark, p) for p in paths))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    place, system = _file_system(spark, path)
    system.create(place, True).close()


def replace_partitions(spark: SparkSession, staged: str, target: str) -> list[str]:
    """Move each folder below ``staged`` to its name below ``target``, in place of what is there; their names."""
    names = [name for name in list_names(spark, staged) if "=" in name]
    for name in names:
        delete_path(spark, f"{target}/{name}")
        move_path(spark, f"{staged}/{name}", f"{target}/{name}")
    return names


def read_layer(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table, lazily; a missing path raises."""
    paths = [path] if isinstance(path, str) else list(path)
    table = spark.read.parquet(*paths)
    return table.select(*columns) if columns else table


scan_layer = read_layer


def read_split(
    spark: SparkSession, path: str | Sequence[str], split: str | None = "train", columns: Sequence[str] | None = None
) -> DataFrame:
    """Bronze readings of one split, or of all with ``split=None``.

    The files of a layer are read as one table; the split is part of the
    partition path, so other files are never opened.
    """
    table = read_layer(spark, path)
    if split is not None:
        table = table.filter(F.regexp_extract("source_file", r"^(train|test|RUL)_", 1) == split)
    return table.select(*columns) if columns else table


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length) of the matching files below a folder, sorted; none if it is missing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, length bigint")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return files.load(path).select("path", "length").orderBy("path")


def require_source(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Source file not found: {path}")
    return path


def discover_sources(spark: SparkSession, source_dir: str, dataset_ids: Sequence[str]) -> dict[str, str]:
    """Path of each train, test and RUL source that exists, a file or a folder of parts, by source name."""
    require_source(spark, source_dir)
    wanted = {name.format(d): f"{source_dir.rstrip('/')}/{name.format(d)}" for d in dataset_ids for name in SOURCE_NAMES}
    return {name: path for name, path in wanted.items() if path_exists(spark, path)}
