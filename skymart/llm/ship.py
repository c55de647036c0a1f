"""Give the Python workers this package where it isn't installed on them."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import SparkSession

import skymart

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the workers, once per application."""
    application = spark.sparkContext.applicationId
    if application in _SENT:
        return
    root = os.path.dirname(os.path.abspath(skymart.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="skymart-"), "skymart.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("skymart", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(archive)
    _SENT.add(application)


def shipped(query: Callable) -> Callable:
    """``query``, sending the package first. Its first argument is the session."""

    @functools.wraps(query)
    def run(spark, *args, **kwargs):
        ship(spark)
        return query(spark, *args, **kwargs)

    return run
