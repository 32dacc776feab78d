"""Outputs of several parts that appear at once: versions are written aside, a manifest names the current one.

    path/versions/<id>/<part>      data of one version
    path/manifest.json             {"version": <id>, "parts": [...]}

A writer fills a fresh version folder part by part and replaces the manifest last, by one rename of a small file. Until then readers
see the version before; a write that breaks off leaves a folder that no manifest names, which ``prune`` removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MANIFEST = "manifest.json"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _files(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _files(spark, path)
    files.delete(target, True)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest, or None where nothing has been written."""
    place = f"{path}/{MANIFEST}"
    if not exists(spark, place):
        return None
    return json.loads("\n".join(r[0] for r in spark.read.text(place, wholetext=True).collect()))


def _replace_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    staged = f"{path}/.{MANIFEST}.{uuid.uuid4().hex}"
    files, target = _files(spark, staged)
    out = files.create(target, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(target, fs.Path(f"{path}/{MANIFEST}"), options)


def write_version(spark: SparkSession, path: str, parts: dict[str, Callable[[str], None]]) -> str:
    """Write every part with its function of a folder, then make them current together; returns the version's id.

    If a part fails, the fresh folder is removed and the version before stays current.
    """
    version = uuid.uuid4().hex
    place = f"{path}/versions/{version}"
    try:
        for name, write in parts.items():
            write(f"{place}/{name}")
    except BaseException:
        remove(spark, place)
        raise
    _replace_manifest(spark, path, {"version": version, "parts": sorted(parts)})
    return version


def part_path(spark: SparkSession, path: str, part: str) -> str:
    """Where the current version keeps a part."""
    manifest = read_manifest(spark, path)
    if manifest is None or part not in manifest["parts"]:
        raise FileNotFoundError(f"{part!r} not found at {path!r}")
    return f"{path}/versions/{manifest['version']}/{part}"


def prune(spark: SparkSession, path: str) -> int:
    """Remove all versions but the current one; not while another writer or an old reader is at work. Returns their number."""
    manifest = read_manifest(spark, path)
    files, target = _files(spark, f"{path}/versions")
    if not files.exists(target):
        return 0
    old = [s.getPath() for s in files.listStatus(target) if manifest is None or s.getPath().getName() != manifest["version"]]
    for place in old:
        files.delete(place, True)
    return len(old)
