"""Catalogue of artifacts that queries share: tokenizers, count models, taggers, run records, frequency tables.

An artifact is named by what it is (with its parameters), the folder it was made from, a fingerprint of that folder's files (names, sizes and times of
change), and a digest of this library's code, so a new version doesn't take over what an old one built.  It is built in a folder of its own; when it is complete, a manifest in the shared folder says where it lies.  The manifest is the commit marker: it is written last
and never overwritten, so a half-built artifact isn't found by anyone, and of two applications that build the same one at once the first wins.  Later applications find
the manifest as well; after a change of the input the name is another one, and the artifact is built anew.
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from glossa.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names: Spark's own checkpoint folder is one level below it, another for each application."""
    return ensure_checkpoint_dir(spark).rstrip("/").rsplit("/", 1)[0]


@functools.cache
def code_digest() -> str:
    here = Path(__file__).parent
    return hashlib.md5(b"".join(p.read_bytes() for d in ("functions", "operators") for p in sorted((here / d).glob("*.py")))).hexdigest()[:12]


def fingerprint(spark: SparkSession, folder: str, tables: tuple[str, ...]) -> str:
    """What tells a state of the ``tables`` of a folder from another: Spark lists their files, nothing in them is read."""
    paths = [f"{folder.rstrip('/')}/{t}.parquet" for t in tables]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                    F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime"))).alias("files")).first()
    return f"{row['n']}-{row['bytes']}-{row['files']}"


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def manifest(spark: SparkSession, path: str) -> dict | None:
    """A committed artifact's manifest, or None."""
    system, target = _file(spark, path)
    if not system.exists(target):
        return None
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))  # one line that ``artifact`` wrote


def artifact(spark: SparkSession, name: str, folder: str, build: Callable[[str], None], tables: tuple[str, ...] = ("documents",)) -> str:
    """Where the artifact ``name`` of the folder's ``tables`` lies; ``build(path)`` writes it first if no application has."""
    root = f"{shared_folder(spark)}/artifacts"
    made_of = f"{fingerprint(spark, folder, tables)}-{code_digest()}"
    key = hashlib.md5(f"{folder}|{made_of}".encode()).hexdigest()[:16]
    entry = f"{root}/{name}-{key}.json"
    known = manifest(spark, entry)
    if known:
        return known["path"]
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    build(path)
    system, target = _file(spark, entry)
    line = json.dumps({"name": name, "folder": folder, "tables": list(tables), "fingerprint": made_of, "path": path})
    draft = f"{root}/_{name}-{uuid.uuid4().hex}.json"
    drafted = system.create(spark._jvm.org.apache.hadoop.fs.Path(draft))
    drafted.write(bytearray(line.encode()))
    drafted.close()
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(draft), target):  # another application was first
        known = manifest(spark, entry)
        if known:
            return known["path"]
    return path
