"""What a build returns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears_mart.schemas import AUDIT_SCHEMA, MANDATORY_SOURCES, RUN_COUNTS
from arrears_mart.sources.checks import missing_sources


@dataclass
class MasterResult:
    """Lazy master and audit frames, and a one-row frame of run counts; `errors` says why a build stopped.

    `stages` are folders that the frames read and nobody needs once they are written.
    """

    base: DataFrame | None = None
    audit: DataFrame | None = None
    metrics: DataFrame | None = None
    status: str = "EXITO"
    errors: list[str] = field(default_factory=list)
    stages: list[str] = field(default_factory=list)

    def clients_unmatched(self) -> bool:
        """Alarm: the master has rows and none of them found its client, so the account keys of the files do not fit."""
        row = self.metrics.first()
        return bool(row.REG_CONSOLIDADOS) and not row.CRUCE_CLIENTES


def stopped(spark: SparkSession, error: str) -> MasterResult:
    """A build that cannot go on: no master, no audit rows, counts of zero."""
    counts = spark.range(1).select(*[F.lit(0).cast("bigint").alias(c) for c in RUN_COUNTS])
    return MasterResult(None, spark.createDataFrame([], AUDIT_SCHEMA), counts, "ERROR", [error])


def missing_error(sources: dict[str, DataFrame]) -> str | None:
    missing = missing_sources(sources, MANDATORY_SOURCES)
    return "Tablas fuente faltantes: " + ", ".join(missing) if missing else None
