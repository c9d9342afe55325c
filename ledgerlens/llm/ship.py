"""Makes this package importable, and files readable, in Python workers.

``spark-submit`` users ship it themselves; in other sessions (a notebook, a
test) the workers may lack it. ``SparkContext.addPyFile`` hands a zip of the
package to every executor, once per context; ``SparkContext.addFile`` does the
same for a vocabulary file, so that only the driver need have it (or any store
that Spark reads: the path may be a URI).
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    target = Path(tempfile.mkdtemp(prefix="ledgerlens-zip-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def ship_file(spark: SparkSession, path: str) -> str:
    """Hand a file to every executor; the name that ``shipped`` takes."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rpartition("/")[2]


def shipped(name: str) -> str:
    """Path, on this executor, of a file that ``ship_file`` handed out."""
    return SparkFiles.get(name)
