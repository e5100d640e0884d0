"""Stored tables with versions: immutable files, a manifest per version, and one publish that readers see whole or not at all.

A file holds the rows of one cell of the key's hash: all keys whose hash begins with the same bits.  A cell that has grown too large is split by
further bits when it is next written, so the number of files follows the size of the table, and a batch rewrites only the files whose
cells hold its keys.  The manifest, a small parquet table, lists the files of a version with their cells, rows and highest mark; a
version is published by creating the file that names its manifest, which fails if that version is there already: the later of two writers
starts again from the newer version.  Old files stay until :func:`vacuum`, so a reader keeps the version it began with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.operators.aggregates import keep_last, relaxed_union

#: Bits of the key's hash that can tell cells apart, and rows of a cell that a split aims at.
BITS, CELL_ROWS = 30, 1_000_000
#: Times a writer starts again after another one was faster.
ATTEMPTS = 20
_DEPTH, _CELL = "_DEPTH", "_CELL"
MANIFEST = "file string, depth int, cell long, n long, mark string"


class Conflict(RuntimeError):
    """Other writers published a version each time this one wanted to."""


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _hash(keys: Sequence[str]) -> Column:
    """Of the keys as text, so that a key column may become a wider type."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(1 << BITS))


def _cell(depth: Column, keys: Sequence[str]) -> Column:
    """The first ``depth`` bits of a key's hash."""
    return F.floor(_hash(keys) / F.pow(F.lit(2.0), F.lit(BITS) - depth)).cast("long")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first; a file that a dying writer left without content is none."""
    fs, folder = _path(spark, f"{path}/_versions")
    if not fs.exists(folder):
        return []
    return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(folder) if s.getLen() > 0 and s.getPath().getName().endswith(".json"))


def _described(spark: SparkSession, path: str, version: int) -> dict:
    rows = spark.read.text(f"{path}/_versions/{version:012d}.json").collect()
    return json.loads("".join(r[0] for r in rows))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The files of a version (the newest): ``file`` below the table's folder, ``depth`` and ``cell``, rows ``n``, highest ``mark`` as text."""
    found = versions(spark, path)
    if not found:
        return spark.createDataFrame([], MANIFEST)
    name = _described(spark, path, found[-1] if version is None else version)["manifest"]
    return spark.read.schema(MANIFEST).parquet(f"{path}/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def _files(spark: SparkSession, path: str, names: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of one version, the newest if none is named; what is published later does not change them."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no version of {path}")
    version = found[-1] if version is None else version
    schema = T.StructType.fromJson(_described(spark, path, version)["schema"])
    return _files(spark, path, [r.file for r in manifest(spark, path, version).select("file").collect()], schema)


def highest_mark(spark: SparkSession, path: str, as_type: str) -> Column:
    """The highest mark of all rows, from the manifest alone; null where there is no table."""
    found = manifest(spark, path).agg(F.max(F.col("mark").cast(as_type)).cast("string")).first()[0]
    return F.lit(found).cast(as_type)


def note(spark: SparkSession, path: str) -> str | None:
    """What the writer of the newest version left with it."""
    found = versions(spark, path)
    return _described(spark, path, found[-1]).get("note") if found else None


def _publish(spark: SparkSession, path: str, version: int, files: DataFrame, schema: T.StructType, left: str | None) -> bool:
    """Whether this writer was the one that made the version."""
    name = f"_manifests/{version:012d}-{uuid.uuid4().hex}"
    files.coalesce(1).write.parquet(f"{path}/{name}")
    fs, target = _path(spark, f"{path}/_versions/{version:012d}.json")
    try:
        out = fs.create(target, False)
    except Exception as exc:  # noqa: BLE001
        if fs.exists(target):
            return False
        raise exc
    out.write(bytearray(json.dumps({"manifest": name, "schema": schema.jsonValue(), "note": left}).encode()))
    out.close()
    return True


def _written(rows: DataFrame, path: str, mark: str | None) -> DataFrame:
    """Rows with their cells as new files, one for each cell, and what the manifest says about them."""
    spark = rows.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    columns = [c for c in rows.columns if c not in (_DEPTH, _CELL)]
    rows.repartition(_DEPTH, _CELL).sortWithinPartitions(_DEPTH, _CELL).write.partitionBy(_DEPTH, _CELL).parquet(f"{path}/{folder}")
    fs, made = _path(spark, f"{path}/{folder}")
    if not any(s.isDirectory() for s in fs.listStatus(made)):
        return spark.createDataFrame([], MANIFEST)
    kept = spark.read.option("basePath", f"{path}/{folder}").schema(T.StructType([*rows.select(*columns).schema.fields, T.StructField(_DEPTH, T.IntegerType()), T.StructField(_CELL, T.LongType())])).parquet(f"{path}/{folder}")
    name = F.concat(F.lit(f"{folder}/"), F.concat_ws("/", F.slice(F.split(F.input_file_name(), "/"), -3, 3)))
    highest = F.max(F.col(mark)).cast("string") if mark else F.lit(None).cast("string")
    return kept.groupBy(name.alias("file"), F.col(_DEPTH).cast("int").alias("depth"), F.col(_CELL).cast("long").alias("cell")).agg(F.count(F.lit(1)).alias("n"), highest.alias("mark"))


def _split(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose cell holds more than twice ``CELL_ROWS`` rows go to as many deeper cells as its size asks for."""
    sizes = rows.groupBy(_DEPTH, _CELL).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * CELL_ROWS)
    deeper = F.least(F.lit(BITS), F.col(_DEPTH) + F.ceil(F.log2(F.col("n") / CELL_ROWS))).cast("int")
    split = rows.join(sizes.select(_DEPTH, _CELL, deeper.alias("_TO")), [_DEPTH, _CELL], "left")
    depth = F.coalesce("_TO", _DEPTH)
    return split.withColumn(_CELL, F.when(F.col("_TO").isNull(), F.col(_CELL)).otherwise(_cell(depth, keys))).withColumn(_DEPTH, depth).drop("_TO")


def _changed(spark: SparkSession, path: str, change: Callable[[int, DataFrame], tuple[DataFrame, T.StructType]], left: str | None) -> int:
    for _ in range(ATTEMPTS):
        before = versions(spark, path)
        number = before[-1] + 1 if before else 1
        while _path(spark, f"{path}/_versions/{number:012d}.json")[0].exists(_path(spark, f"{path}/_versions/{number:012d}.json")[1]):
            number += 1  # left empty by a writer that died
        files, schema = change(number, manifest(spark, path))
        if _publish(spark, path, number, files, schema, left):
            return number
    raise Conflict(f"{path}: {ATTEMPTS} versions were published by others meanwhile")


def replace(rows: DataFrame, path: str, keys: Sequence[str], mark: str | None = None, left: str | None = None) -> int:
    """The table's next version has these rows and no others; its number is returned."""
    spark = rows.sparkSession
    placed = rows.withColumns({_DEPTH: F.lit(0), _CELL: F.lit(0).cast("long")})
    return _changed(spark, path, lambda number, _: (_written(_split(placed, keys), path, mark), rows.schema), left)


def _homes(rows: DataFrame, files: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[int]]:
    """The file whose cell holds a row's key (``keys, depth, cell, file``; none for a key whose cell is empty), and the depths there are."""
    depths = sorted(r.depth for r in files.select("depth").distinct().collect())  # thirty at most
    asked = rows.select(*keys, F.explode(F.array(*[F.lit(d) for d in depths or [0]])).alias("depth"))
    asked = asked.withColumn("cell", _cell(F.col("depth"), keys))
    return asked.join(files.select("depth", "cell", "file"), ["depth", "cell"]), depths


def lookup(asked: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """The stored rows of some keys; only the files whose cells hold them are read."""
    spark = asked.sparkSession
    schema = T.StructType.fromJson(_described(spark, path, versions(spark, path)[-1])["schema"])
    hit, _ = _homes(asked.select(*keys).distinct(), manifest(spark, path), keys)
    return _files(spark, path, [r.file for r in hit.select("file").distinct().collect()], schema).join(asked.select(*keys).distinct(), list(keys), "left_semi")


def upsert(batch: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], newest: bool = False, mark: str | None = None, excluded: Sequence[str] = (), left: str | None = None) -> int:
    """Rows of the batch replace stored rows with the same key, the last of a key by ``order`` first; a new version, whose number is returned.

    ``newest``: stored rows take part in the order, so that a late batch does not undo a newer one.  ``mark``: the column whose highest
    value the manifest keeps for each file.  ``excluded`` columns serve the order and are not stored.  Null keys equal nothing and are
    left out.  An empty batch makes a version with the same files.  ``left``: a note that is published with the version.
    """
    if not keys or not order:
        raise ValueError("an upsert needs the unique key, and the order that makes one row of a key the last")
    spark = batch.sparkSession
    latest = keep_last(batch.dropna(subset=list(keys)), list(keys), order).drop(*excluded)
    if not exists(spark, path):
        return replace(latest, path, keys, mark, left)
    from navloom.sources.ingest import staged

    with staged(latest) as rows:

        def change(number: int, files: DataFrame) -> tuple[DataFrame, T.StructType]:
            schema = T.StructType.fromJson(_described(spark, path, versions(spark, path)[-1])["schema"])
            hit, depths = _homes(rows, files, keys)
            deepest = depths[-1] if depths else 0
            touched = [r.file for r in hit.select("file").distinct().collect()]  # names of files, as many as the change rewrites
            homes = rows.join(hit.select(*keys, F.col("depth").alias(_DEPTH), F.col("cell").alias(_CELL)), list(keys), "left")
            homes = homes.withColumn(_CELL, F.coalesce(_CELL, _cell(F.lit(deepest), keys))).withColumn(_DEPTH, F.coalesce(_DEPTH, F.lit(deepest)))
            stored = _files(spark, path, touched, schema)
            places = hit.select("depth", "cell").distinct()
            depth = F.explode(F.array(*[F.lit(d) for d in depths or [0]]))
            own = stored.withColumn(_DEPTH, depth).withColumn(_CELL, _cell(F.col(_DEPTH), keys)).join(F.broadcast(places) if len(touched) <= 100_000 else places, (F.col(_DEPTH) == F.col("depth")) & (F.col(_CELL) == F.col("cell")), "left_semi")
            if newest:
                both = relaxed_union(own, homes)
                merged = keep_last(both, list(keys), order)
            else:
                merged = relaxed_union(own.join(rows.select(*keys), list(keys), "left_anti"), homes)
            made = _written(_split(merged, keys), path, mark)
            kept = files.join(spark.createDataFrame([(t,) for t in touched], "file string"), "file", "left_anti") if touched else files
            return kept.select("file", "depth", "cell", "n", "mark").union(made.select("file", "depth", "cell", "n", "mark")), merged.drop(_DEPTH, _CELL).schema

        return _changed(spark, path, change, left)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Removes the files and manifests that none of the last ``keep`` versions names; readers of older versions must be done.  Files removed."""
    found = versions(spark, path)
    stay = found[-keep:]
    named = {_described(spark, path, v)["manifest"] for v in stay}
    needed = {r.file for v in stay for r in manifest(spark, path, v).select("file").collect()}
    fs, data = _path(spark, f"{path}/data")
    gone, each = 0, fs.listFiles(data, True)
    root = fs.makeQualified(_path(spark, path)[1]).toString().rstrip("/") + "/"
    while each.hasNext():
        file = each.next().getPath()
        name = file.toString().removeprefix(root)
        if name.endswith(".parquet") and name not in needed:
            gone += bool(fs.delete(file, False))
    for v in found[:-keep] if keep < len(found) else []:
        fs.delete(_path(spark, f"{path}/_versions/{v:012d}.json")[1], False)
    for s in fs.listStatus(_path(spark, f"{path}/_manifests")[1]):
        if f"_manifests/{s.getPath().getName()}" not in named:
            fs.delete(s.getPath(), True)
    return gone
