"""Technologies detected on a flattened resource, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.functions.keys import asset_key, hash_key
from duskline.functions.normalize import runtime_parts
from duskline.functions.text import none_if_blank

# What shows a technology. One row per technology: family, source,
# name rule, columns of the version (the first filled one counts), column of the
# flag. The name rule is the name itself, "parts of <column>" for a column that
# holds name|version, or "value of <column>" for a column that holds the name; a
# technology shows where its name and shown-by column are filled.
TECHNOLOGIES = (
    ("app_runtime", "linux_fx_version", "parts of runtime_linux_fx_version", (), None),
    ("app_runtime", "windows_fx_version", "parts of runtime_windows_fx_version", (), None),
    ("app_runtime", "runtime_node_version", "node", ("runtime_node_version",), None),
    ("app_runtime", "runtime_python_version", "python", ("runtime_python_version",), None),
    ("app_runtime", "runtime_dotnet_version", "dotnet", ("runtime_dotnet_version",), None),
    ("app_runtime", "runtime_java_version", "java", ("runtime_java_version",), None),
    ("app_runtime", "runtime_php_version", "php", ("runtime_php_version",), None),
    ("app_runtime", "runtime_powershell_version", "powershell", ("runtime_powershell_version",), None),
    ("container_orchestration", "kubernetes_version", "kubernetes", ("aks_kubernetes_version_current", "aks_kubernetes_version"), None),
    ("key_vault_config", "rbac_authorization", "rbac_authorization", (), "kv_rbac_enabled"),
    ("key_vault_config", "soft_delete", "soft_delete", (), "kv_soft_delete_enabled"),
    ("virtual_machine", "os_image", "value of vm_os_type", ("vm_image_sku",), "vm_image_offer"),
    ("database", "db_version", "sql", ("db_version",), "sql_service_objective"),
    ("storage_config", "tls_version", "tls", ("storage_minimum_tls_version",), None),
)
# End of the fixed values.


def _technology(columns: list[str], family: str, source: str, rule: str, versions: tuple[str, ...], flag: str | None) -> Column | None:
    """The technology as a struct with a null name where it does not show; None without its columns."""
    empty = F.lit(None).cast("string")
    filled = {c: none_if_blank(c) for c in columns}
    how, _, column = rule.rpartition(" of ")
    version = F.coalesce(empty, *[filled[c] for c in versions if c in filled])
    if how:
        if column not in filled:
            return None
        parts = runtime_parts(filled[column])
        name, version = parts if how == "parts" else (F.lower(filled[column]), version)
    else:
        # A fixed name shows by its version or, without one, by its flag.
        shown_by = [c for c in (versions or (flag,)) if c in filled]
        if not shown_by:
            return None
        name = F.when(F.coalesce(*[filled[c] for c in shown_by]).isNotNull(), F.lit(rule))
    return F.struct(
        F.lit(family).alias("technology_family"),
        F.lit(source).alias("technology_source"),
        name.alias("runtime_name"),
        version.alias("runtime_version"),
        filled.get(flag, empty).alias("feature_flag"),
    )


def detect_technology(flat: DataFrame) -> DataFrame:
    """One row per technology of each resource: the input is read once and unfolded.

    Expects one row per resource. Raises when no detectable column is present.
    """
    shown = [t for t in (_technology(flat.columns, *row) for row in TECHNOLOGIES) if t is not None]
    if not shown:
        raise ValueError("the input has none of the columns technologies are detected from")
    rows = F.array(*shown)
    present = F.filter(rows, lambda r: r["runtime_name"].isNotNull())
    return flat.select("resource_id", "resource_type", "subscription_id", "resource_name", F.inline(present))


def asset_technology(flat: DataFrame, provider: str, source_system: str, conformed_at: Column) -> DataFrame:
    """Detected technologies with their keys and load columns."""
    return detect_technology(flat).select(
        hash_key("resource_id", "technology_family", "technology_source").alias("tech_sk"),
        "resource_id",
        asset_key(F.lit(provider), "subscription_id", "resource_type", "resource_name").alias("asset_nk"),
        "resource_type",
        "technology_family",
        "technology_source",
        "runtime_name",
        "runtime_version",
        "feature_flag",
        F.lit(provider).alias("cloud_provider"),
        F.lit(source_system).alias("source_system"),
        conformed_at.alias("conformance_at"),
    )
