"""Reading tables of the raw, silver and gold layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("raw", "silver", "gold", "quarantine", "quality")


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; known: {', '.join(LAYERS)}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer, name))


def read_tables(spark: SparkSession, root: str, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_layer(spark, root, layer, name) for name in names}


def _folder(spark: SparkSession, path: str):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column, from the directory listing alone."""
    root, files = _folder(spark, path)
    if not files.exists(root):
        return []
    names = [status.getPath().getName() for status in files.listStatus(root) if status.isDirectory()]
    prefix = f"{column}="
    return sorted(name[len(prefix) :] for name in names if name.startswith(prefix))


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    root, files = _folder(spark, f"{path}/{column}={value}")
    files.delete(root, True)


def sized_files(spark: SparkSession, path: str, column: str, value: str) -> dict[str, int]:
    """Bytes of each data file of a partition, from the directory listing alone."""
    root, files = _folder(spark, f"{path}/{column}={value}")
    named = [(status.getPath().getName(), status.getLen()) for status in files.listStatus(root) if status.isFile()]
    return {name: size for name, size in named if not name.startswith(("_", "."))}


def child_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    root, files = _folder(spark, path)
    if not files.exists(root):
        return []
    names = [status.getPath().getName() for status in files.listStatus(root) if status.isDirectory()]
    return sorted(name for name in names if name.startswith(prefix))


def move(spark: SparkSession, path: str, target: str) -> None:
    root, files = _folder(spark, path)
    if not files.rename(root, _folder(spark, target)[0]):
        raise OSError(f"{path} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    root, files = _folder(spark, path)
    files.delete(root, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    root, files = _folder(spark, f"{path}.tmp")
    out = files.create(root, True)
    out.write(bytearray(text.encode()))
    out.close()
    move(spark, f"{path}.tmp", path)


def read_text(spark: SparkSession, path: str) -> str:
    root, files = _folder(spark, path)
    data = files.open(root)
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()


def is_file(spark: SparkSession, path: str) -> bool:
    root, files = _folder(spark, path)
    return files.exists(root) and files.getFileStatus(root).isFile()


def exists(spark: SparkSession, path: str) -> bool:
    root, files = _folder(spark, path)
    return files.exists(root)
