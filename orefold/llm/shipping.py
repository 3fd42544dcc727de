"""The package for Python workers that cannot import it from where they run."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

import orefold
from orefold.session import hadoop_path, scratch_path


def ship(spark: SparkSession) -> None:
    """Hand the package to this application's workers, once, by way of the shared scratch folder."""
    context = spark.sparkContext
    if getattr(context, "_orefold_shipped", False):
        return
    context._orefold_shipped = True
    root = os.path.dirname(os.path.abspath(orefold.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    files, path = hadoop_path(spark, scratch_path(spark, "package") + ".zip")
    out = files.create(path)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(path.toString())
