"""Session helpers: where shared files go, and how lineage is cut."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
OWN_NAME = re.compile(r"/[^/]+-[0-9a-f]{32}$")  # of folders that new_path names
_own: dict[str, str] = {}  # folders of local sessions without the setting, by application


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a local session without the setting, as in tests, gets a temporary folder, which goes when Python
    ends; on a cluster a missing setting is an error, since a machine-local folder would be lost with its
    machine.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="stylograph-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, schema: StructType | None = None, options: dict[str, str | int] | None = None) -> DataFrame:
    """Write once to the shared folder and read back, as ``schema`` if given: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.options(**{"compression": "zstd", **(options or {})}).parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes what ``materialize`` wrote for these tables, once nothing reads it any more; other inputs stay."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if OWN_NAME.search(path):
                at = context._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
