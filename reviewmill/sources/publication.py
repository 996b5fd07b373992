"""Publications of a lake: complete sets of tables, each named by one small manifest.

A run writes all its tables below a folder of its own, ``BASE/runs/RUN``, where no reader looks. Publishing
creates ``BASE/_published/NUMBER.json``, which names that folder; the highest readable number is what
readers see. So readers find all tables of one run or all of another, never a mixture, whatever a
run dies of. Files are created and deleted, never renamed or overwritten, so object stores will do.

A manifest that is being written, or was left half written, can't be parsed and doesn't count. Of two
runs that publish at once each gets a number, and the later one shows; a run that has built on an
earlier publication says so (``after``) and fails if that is no longer the current one.
"""

from __future__ import annotations

import json
import time
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession

from reviewmill.sources import files

RUNS, MANIFESTS = "runs", "_published"


class Publication(NamedTuple):
    """A published set of tables: its number, its folder, and the rows of each table."""

    version: int
    root: str
    rows: dict[str, int]


class Superseded(RuntimeError):
    """Another publication has come in between."""


def new_run(base: str) -> str:
    """A folder for a run's tables."""
    return f"{base.rstrip('/')}/{RUNS}/{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex}"


def _path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/{MANIFESTS}/{version:012d}.json"


def _versions(spark: SparkSession, base: str) -> list[int]:
    """All numbers that have been taken, the latest first."""
    entries = files.names(spark, f"{base.rstrip('/')}/{MANIFESTS}")
    return sorted((int(n[:-5]) for n in entries if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _read(spark: SparkSession, base: str, version: int) -> Publication | None:
    try:
        manifest = json.loads(files.read_text(spark, _path(base, version)))
    except ValueError:
        return None
    return Publication(version, f"{base.rstrip('/')}/{manifest['root']}", manifest["rows"])


def history(spark: SparkSession, base: str) -> list[Publication]:
    """All publications, the current one first."""
    found = (_read(spark, base, version) for version in _versions(spark, base))
    return [publication for publication in found if publication]


def current(spark: SparkSession, base: str) -> Publication | None:
    """What readers see now, None where nothing has been published."""
    found = (_read(spark, base, version) for version in _versions(spark, base))
    return next((publication for publication in found if publication), None)


def root_of(spark: SparkSession, base: str) -> str:
    """The folder of the current tables: the base folder itself where nothing has been published."""
    published = current(spark, base)
    return published.root if published else base.rstrip("/")


def publish(
    spark: SparkSession, base: str, root: str, rows: dict[str, int], after: int | None = None
) -> Publication:
    """Make a run's tables the current ones.

    after: the publication that the run has built on (0: none); another one since makes this fail.
    """
    base = base.rstrip("/")
    manifest = json.dumps({"root": root.removeprefix(f"{base}/"), "rows": rows}, sort_keys=True)
    while True:
        taken = _versions(spark, base)
        if after is not None:
            seen = current(spark, base)
            if (seen.version if seen else 0) != after:
                raise Superseded(f"{base} is at publication {seen.version if seen else 0}, not {after}")
        version = taken[0] + 1 if taken else 1
        if files.create_text(spark, _path(base, version), manifest):
            return Publication(version, root, rows)


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete what lies before the last ``keep`` publications; the folders that went.

    A reader that has resolved its tables is safe until ``keep`` more runs have published. A folder goes
    before its manifest, so a vacuum that breaks off leaves nothing that a later one doesn't find. Folders that
    were never published belong to running runs, or to ones that were killed, and stay.
    """
    gone = []
    for old in history(spark, base)[max(1, keep) :]:
        files.remove_folder(spark, old.root)
        files.remove_folder(spark, _path(base, old.version))
        gone.append(old.root)
    return gone
