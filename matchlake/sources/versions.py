"""Tables kept as versions: folders of data files, and a manifest that names those of the current version.

A version becomes visible when its manifest is renamed into place, and not before; a run that dies earlier
leaves files that no manifest names. The table exists once a manifest does. The manifest holds the schema, so an
empty table can be read. One writer at a time is assumed; readers of the version before keep their files until the
commit after the next.
"""

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"
PART = "_part"
# Manifests whose files are kept.
KEPT = 2


def _storage(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, storage = _storage(spark, path)
    return storage.exists(folder)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, storage = _storage(spark, f"{path}/{MANIFESTS}")
    if not storage.exists(folder):
        return []
    names = [f.getPath().getName() for f in storage.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _load(spark: SparkSession, path: str, number: int) -> dict:
    file, storage = _storage(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    stream = storage.open(file)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> dict | None:
    """Manifest of the current version: number, schema, and folders by partition; None without a version."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def read(spark: SparkSession, path: str, manifest: dict | None = None, parts: set[str] | None = None) -> DataFrame:
    """The current version, or some of its partitions."""
    manifest = manifest or current(spark, path)
    schema = StructType.fromJson(manifest["schema"])
    folders = [f"{path}/{f}" for part, f in sorted(manifest["folders"].items()) if parts is None or part in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def part_of(partition_by: str | None):
    """Folder name of a row's partition."""
    return F.coalesce(F.col(partition_by).cast("string"), F.lit("__none__")) if partition_by else F.lit("all")


def write_files(df: DataFrame, path: str, partition_by: str | None) -> dict[str, str]:
    """Writes data files that no version has yet; folders by partition. Rows are evened out per partition first."""
    spark, data = df.sparkSession, f"data/{uuid.uuid4().hex}"
    placed = df.withColumn(PART, part_of(partition_by)).hint("rebalance", PART)
    placed.write.partitionBy(PART).parquet(f"{path}/{data}")
    folder, storage = _storage(spark, f"{path}/{data}")
    found = {}
    for entry in storage.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith(f"{PART}="):
            found[unquote(name.removeprefix(f"{PART}="))] = f"{data}/{name}"
    return found


def commit(spark: SparkSession, path: str, schema: StructType, folders: dict[str, str]) -> None:
    """Makes a version of these folders current, and removes data that no kept version names."""
    numbers = _numbers(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    manifest = {"number": number, "schema": json.loads(schema.json()), "folders": folders}
    draft, storage = _storage(spark, f"{path}/{MANIFESTS}/draft-{uuid.uuid4().hex}")
    stream = storage.create(draft, True)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    final, _ = _storage(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    if storage.exists(final) or not storage.rename(draft, final):
        raise RuntimeError(f"another writer has committed version {number} of {path}")
    _clean(spark, path)


def _clean(spark: SparkSession, path: str) -> None:
    numbers = _numbers(spark, path)
    kept = {f for n in numbers[-KEPT:] for f in _load(spark, path, n)["folders"].values()}
    for n in numbers[:-KEPT]:
        file, storage = _storage(spark, f"{path}/{MANIFESTS}/{n:012d}.json")
        storage.delete(file, False)
    top, storage = _storage(spark, f"{path}/data")
    if not storage.exists(top):
        return
    for entry in storage.listStatus(top):
        name = f"data/{entry.getPath().getName()}"
        if not any(f.startswith(f"{name}/") for f in kept):
            storage.delete(entry.getPath(), True)
