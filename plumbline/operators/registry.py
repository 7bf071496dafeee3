"""Run logs, model versions and aliases, as append-only tables."""

from __future__ import annotations

import datetime
import os
import urllib.parse
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.sources.tables import read_log


def run_rows(
    spark: SparkSession, run_id: str, params: Mapping[str, object], metrics: Mapping[str, float]
) -> DataFrame:
    """Parameters and metrics of a run, one row each."""
    rows = [(run_id, "param", key, str(value)) for key, value in params.items()]
    rows += [(run_id, "metric", key, str(value)) for key, value in metrics.items()]
    return spark.createDataFrame(rows, schemas.RUN_LOG)


def trial_rows(trials: DataFrame, search_id: str) -> DataFrame:
    """A search's trials in the shape of a run log: each trial is a run."""
    run_id = F.concat(F.lit(search_id), F.lit("-"), F.col("trial_id"))
    entries = F.array(
        F.struct(F.lit("param").alias("kind"), F.lit("C").alias("key"), F.col("c").cast("string").alias("value")),
        F.struct(F.lit("param").alias("kind"), F.lit("solver").alias("key"), F.col("solver").alias("value")),
        F.struct(
            F.lit("metric").alias("kind"), F.lit("accuracy").alias("key"), F.col("accuracy").cast("string").alias("value")
        ),
    )
    return trials.select(run_id.alias("run_id"), F.inline(entries))


def next_versions(versions: DataFrame, names: DataFrame) -> DataFrame:
    """For each name: one more than its highest version, or 1."""
    highest = versions.groupBy("name").agg(F.max("version").alias("version"))
    return names.join(highest, "name", "left").select(
        "name", (F.coalesce("version", F.lit(0)) + 1).cast("int").alias("version")
    )


def current_aliases(assignments: DataFrame) -> DataFrame:
    """Where each alias points: its last assignment wins."""
    when = F.struct("assigned_at", "version")
    return assignments.groupBy("name", "alias").agg(
        F.max_by("version", when).alias("version"), F.max("assigned_at").alias("assigned_at")
    )


def resolve(versions: DataFrame, assignments: DataFrame, name: str, alias: str) -> str | None:
    """Where the artefact of an aliased model is stored."""
    mine = current_aliases(assignments.where((F.col("name") == name) & (F.col("alias") == alias)))
    found = versions.join(mine.select("name", "version"), ["name", "version"]).select("uri").first()
    return found.uri if found else None


def ledger_rows(ledger: DataFrame) -> DataFrame:
    """Finished trials of any searches in the shape of a run log; those without an accuracy have no such row."""
    run_id = F.concat("search_id", F.lit("-"), "trial_id")
    cells = (("param", "C", "c"), ("param", "solver", "solver"), ("metric", "accuracy", "accuracy"))
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), F.col(c).cast("string").alias("value")) for kind, key, c in cells])
    return ledger.select(run_id.alias("run_id"), F.inline(entries)).where("value IS NOT NULL")


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that nobody else has created; says whether it was this call that did.

    On a local or mounted folder by the operating system's exclusive creation, else by that of Hadoop's file system, which its
    name server decides (an object store needs conditional creation switched on).
    """
    parts = urllib.parse.urlparse(path)
    if parts.scheme in ("", "file"):
        local = urllib.parse.unquote(parts.path) if parts.scheme else path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        system.create(place, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


class Registry:
    """The three tables at one place, for any number of writers.

    Each append lies in a folder of its own, so writers don't meet.  A version belongs to who created its claim; a
    claim whose writer was lost leaves a gap in the numbers and nothing else.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _log(self, table: str, schema: str) -> DataFrame:
        return read_log(self.spark, f"{self.root}/{table}", schema, nested=True)

    def _append(self, rows: DataFrame, table: str, entry: str) -> None:
        rows.coalesce(1).write.parquet(f"{self.root}/{table}/entry={entry}")

    @property
    def runs(self) -> DataFrame:
        return self._log("run_log", schemas.RUN_LOG)

    @property
    def versions(self) -> DataFrame:
        return self._log("model_version", schemas.MODEL_VERSION)

    @property
    def aliases(self) -> DataFrame:
        return self._log("model_alias", schemas.MODEL_ALIAS)

    def log_run(self, rows: DataFrame) -> None:
        self._append(rows, "run_log", uuid.uuid4().hex)

    def register(self, name: str, run_id: str, uri: str, at: datetime.datetime) -> int:
        """Add the next version of a model and say which it is."""
        asked = self.spark.createDataFrame([(name,)], "name string")
        version = next_versions(self.versions.where(F.col("name") == name), asked).first().version
        quoted = urllib.parse.quote(name, safe="")
        while not claim(self.spark, f"{self.root}/claims/{quoted}/{version}"):
            version += 1
        row = self.spark.createDataFrame([(name, version, run_id, uri, at)], schemas.MODEL_VERSION)
        self._append(row, "model_version", uuid.uuid4().hex)
        return version

    def point(self, name: str, alias: str, version: int, at: datetime.datetime) -> None:
        """Let an alias point at a version from now on."""
        row = self.spark.createDataFrame([(name, alias, version, at)], schemas.MODEL_ALIAS)
        self._append(row, "model_alias", uuid.uuid4().hex)

    def uri(self, name: str, alias: str) -> str | None:
        return resolve(self.versions, self.aliases, name, alias)
