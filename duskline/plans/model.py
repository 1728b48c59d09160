"""Names of the notice dimension and the measures each report view uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Model name of each notice column.
NOTICE_NAMES = {
    "deprecation_sk": "deprecation_sk",
    "vendor": "Proveedor",
    "notice_id": "notice_id",
    "notice_title": "Titulo del Aviso",
    "technology_family": "Familia Tecnologica",
    "affected_service": "Servicio Afectado",
    "affected_runtime": "Runtime Afectado",
    "affected_version": "Version Afectada",
    "published_at": "Publicado",
    "retirement_at": "Fecha de Retiro",
    "severity": "Severidad",
    "impact_scope": "Alcance del Impacto",
    "status": "Estado",
}


def notice_dimension(events: DataFrame) -> DataFrame:
    """The notice dimension under its model names."""
    return events.select(*[F.col(c).alias(name) for c, name in NOTICE_NAMES.items()])
