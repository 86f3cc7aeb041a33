"""Incremental intake of landed payloads (SRC-1, JOB-3).

Landings grow: every day new files appear next to those already loaded.
``intake`` runs a file stream over the landing with ``availableNow``: Spark's
checkpoint holds the ledger of the files taken, a run plans only the files that
are new, parses each document once, and commits the parsed documents together
with the ledger.  A run that dies is finished by the next one: the same files,
planned again under the same batch number, replace what it left, so a document
is taken exactly once.  Runs over a growing landing add up to one run over all.

The sink is a folder of Parquet files with Spark's own commit log; reading it
with ``read_intake`` sees committed batches only.  The documents are kept
parsed and whole, with the file they came from, so accepted rows and rejects
are both taken from it and no landing is read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.sources.payloads import payload_stream


@dataclass(frozen=True)
class IntakeReport:
    batches: int
    documents: int  # taken by this run


def intake(spark: SparkSession, landing: str, target: str, *, wholetext: bool = False,
           max_files: int | None = None) -> IntakeReport:
    """Take all files under ``landing`` (subfolders too) that earlier runs into ``target`` have not.

    ``target`` is a folder on shared storage; the ledger lies beside it, in ``<target>_ledger``.
    ``max_files`` bounds the files of one micro-batch, for first runs over a long history: every
    file is still taken, in several batches."""
    documents = payload_stream(spark, landing, wholetext=wholetext, max_files=max_files)
    query = (documents.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{target.rstrip('/')}_ledger").trigger(availableNow=True).start(target))
    query.awaitTermination()
    done = [p for p in query.recentProgress if p["numInputRows"]]
    return IntakeReport(len(done), sum(p["numInputRows"] for p in done))


def read_intake(spark: SparkSession, target: str) -> DataFrame:
    """All documents taken so far, as ``read_payloads`` gives them, plus ``landed_file``."""
    return spark.read.parquet(target)


def intake_files(spark: SparkSession, target: str) -> DataFrame:
    """The files taken so far: landed_file and its documents."""
    return read_intake(spark, target).groupBy("landed_file").agg(F.count(F.lit(1)).alias("documents"))
