"""The package on the executors: Python tasks import it there."""

import tempfile
import zipfile
from pathlib import Path

import tidemark
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to all executors, once for each application.

    The driver serves the archive; executors lost and replaced fetch it again.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(tidemark.__file__).parent
    archive = Path(tempfile.mkdtemp()) / "tidemark_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, str(Path(top.name) / file.relative_to(top)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
