"""Publishing a run as a whole: every change of what readers see is one rename.

A job writes its datasets into a folder of its own and then commits a manifest
``_manifest/v=<n>``, one row that names the folder. Readers take the highest
version, so they see the run before or the run after, never a mix, and a job
that fails half-way changes nothing they see. The commit is a rename that fails
if the version exists: of two jobs that publish at once, one must start over.

A refresh replaces some sale months only. It writes these months of every
day-keyed dataset into a folder of its own, and its manifest's ``months`` says
which months come from which folder; the others still come from ``folder``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from possum.operators.base import MONTH
from possum.plans.common import remove_folder

_SCHEMA = ("today string, synced string, last_updated string, datasets array<string>, folder string, "
           "months map<string,string>, moved string, lines_of map<string,array<string>>, applied map<string,bigint>")


class Manifest(NamedTuple):
    version: int
    folder: str
    datasets: tuple[str, ...] = ()
    months: Mapping[str, str] = {}      # sale month -> folder that holds it instead
    moved: str | None = None            # where lines of moved transactions are stored (streaming.retract)
    lines_of: Mapping[str, Sequence[str]] = {}  # sale month -> other months under which its lines may be stored
    applied: Mapping[str, int] = {}     # stream -> last applied batch
    today: str | None = None
    synced: str | None = None
    last_updated: str | None = None


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    target, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _fs(spark, path)
    return fs.exists(target)


def versions(spark: SparkSession, out_dir: str) -> list[int]:
    """The committed versions, oldest first."""
    return sorted(int(n[2:]) for n in _children(spark, os.path.join(out_dir, "_manifest")) if n.startswith("v=") and n[2:].isdigit())


def read_manifest(spark: SparkSession, out_dir: str, version: int | None = None) -> Manifest | None:
    """A version of the manifest, the newest by default; None if nothing has been published."""
    if version is None:
        known = versions(spark, out_dir)
        if not known:
            return None
        version = known[-1]
    row = spark.read.schema(_SCHEMA).json(os.path.join(out_dir, "_manifest", f"v={version:08d}")).first()
    return Manifest(version, row.folder, tuple(row.datasets or ()), dict(row.months or {}), row.moved,
                    {k: tuple(v) for k, v in (row.lines_of or {}).items()}, dict(row.applied or {}),
                    row.today, row.synced, row.last_updated)


def commit(spark: SparkSession, out_dir: str, manifest: Manifest) -> int:
    """Publish ``manifest`` as the version after ``manifest.version``."""
    version = manifest.version + 1
    root = os.path.join(out_dir, "_manifest")
    draft = os.path.join(root, f".draft-{uuid.uuid4().hex}")
    row = (manifest.today, manifest.synced, manifest.last_updated, list(manifest.datasets), manifest.folder, dict(manifest.months),
           manifest.moved, {k: sorted(v) for k, v in manifest.lines_of.items()}, dict(manifest.applied))
    spark.createDataFrame([row], _SCHEMA).coalesce(1).write.json(draft)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, root)[1].getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    # without OVERWRITE the rename fails if another job has published this version
    context.rename(path(draft), path(os.path.join(root, f"v={version:08d}")), options)
    return version


def with_moves(lines_of: Mapping[str, Sequence[str]], moves: Iterable[tuple[str, str]]) -> dict[str, tuple[str, ...]]:
    """``lines_of`` after transactions moved from one month to another.

    Lines stay in the month folder they were stored in, which need not be the
    month their transaction comes from: it may have moved before.
    """
    before = {k: set(v) for k, v in lines_of.items()}
    after = {k: set(v) for k, v in lines_of.items()}
    for old, new in moves:
        after.setdefault(new, set()).update({old} | before.get(old, set()))
    return {k: tuple(sorted(v - {k})) for k, v in after.items() if v - {k}}


def read_published(spark: SparkSession, out_dir: str, name: str, fmt: str = "json") -> DataFrame:
    """A dataset as published; the months a refresh replaced come from its folder."""
    m = read_manifest(spark, out_dir)
    if m is None:
        raise ValueError(f"nothing is published in {out_dir}")
    return read_version(spark, m, name, fmt)


def read_version(spark: SparkSession, m: Manifest, name: str, fmt: str = "json", months: Sequence[str] | None = None) -> DataFrame:
    """A dataset of a manifest, or these months of it."""
    def load(folder: str) -> DataFrame | None:
        path = os.path.join(folder, name)
        if not exists(spark, path):
            return None
        try:
            return spark.read.format(fmt).load(path)
        except AnalysisException:     # a dataset without a row has no schema to infer
            return None

    parts = []
    base = load(m.folder)
    if base is not None and MONTH in base.columns:
        here = ~F.col(MONTH).isin(*m.months) if m.months else F.lit(True)
        parts.append(base.where(here if months is None else here & F.col(MONTH).isin(*months)))
    elif base is not None:
        parts.append(base)
    for folder in sorted(set(m.months.values())):
        own = [k for k, f in m.months.items() if f == folder and (months is None or k in months)]
        part = load(folder) if own else None
        if part is not None and MONTH in part.columns:
            parts.append(part.where(F.col(MONTH).isin(*own)))
    if not parts:
        raise ValueError(f"no rows of {name} are published")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def expire(spark: SparkSession, out_dir: str, keep: int = 2) -> None:
    """Remove manifests before the last ``keep`` and the run folders that no kept one names.

    Folders of a version that is being written are named by no manifest yet:
    only folders that an expired manifest names are removed.
    """
    known = versions(spark, out_dir)
    old, new = known[:-keep], known[-keep:]

    def folders(version: int) -> set[str]:
        m = read_manifest(spark, out_dir, version)
        return {m.folder, *m.months.values()} | ({os.path.dirname(os.path.dirname(m.moved))} if m.moved else set())

    kept = set().union(*(folders(v) for v in new)) if new else set()
    for v in old:
        gone = folders(v) - kept
        for folder in gone:
            if os.path.dirname(folder.rstrip("/")) == out_dir.rstrip("/"):
                remove_folder(spark, folder)
        remove_folder(spark, os.path.join(out_dir, "_manifest", f"v={v:08d}"))
