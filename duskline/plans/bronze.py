"""Raw tables: landed rows with load columns, flattened resources, tags, accounts, notices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskline.functions.keys import hash_key
from duskline.operators.tags import explode_tags
from duskline.session import ts_lit


@dataclass(frozen=True)
class Origin:
    """Constants stamped on every loaded row."""

    source_system: str = "duskline"
    cloud_provider: str = "azure"
    vendor: str = "microsoft"
    account_type: str = "azure_subscription"
    notice_service: str = "azure.release_communications"


LOAD_COLUMNS = ["ingestion_id", "source_system", "cloud_provider", "collected_at", "source_path"]

# ---------------------------------------------------------------------------
# Flattened column and the path of its value in `properties`.
PROPERTY_PATHS = {
    "provisioning_state": "provisioningState",
    "state": "state",
    "description": "description",
    "runtime_linux_fx_version": "siteConfig.linuxFxVersion",
    "runtime_windows_fx_version": "siteConfig.windowsFxVersion",
    "runtime_node_version": "siteConfig.nodeVersion",
    "runtime_python_version": "siteConfig.pythonVersion",
    "runtime_dotnet_version": "siteConfig.netFrameworkVersion",
    "runtime_java_version": "siteConfig.javaVersion",
    "runtime_php_version": "siteConfig.phpVersion",
    "runtime_powershell_version": "siteConfig.powerShellVersion",
    "aks_kubernetes_version": "kubernetesVersion",
    "aks_kubernetes_version_current": "currentKubernetesVersion",
    "aks_node_resource_group": "nodeResourceGroup",
    "kv_rbac_enabled": "enableRbacAuthorization",
    "kv_soft_delete_enabled": "enableSoftDelete",
    "kv_soft_delete_retention_days": "softDeleteRetentionInDays",
    "vm_size": "hardwareProfile.vmSize",
    "vm_os_type": "storageProfile.osDisk.osType",
    "vm_image_offer": "storageProfile.imageReference.offer",
    "vm_image_sku": "storageProfile.imageReference.sku",
    "vm_image_version": "storageProfile.imageReference.version",
    "sql_service_objective": "currentServiceObjectiveName",
    "sql_collation": "collation",
    "db_version": "version",
    "acr_login_server": "loginServer",
    "storage_access_tier": "accessTier",
    "storage_minimum_tls_version": "minimumTlsVersion",
}
# ---------------------------------------------------------------------------


def bronze_metadata(
    df: DataFrame, run_ts, origin: Origin = Origin(), source_path: str | Column | None = None
) -> DataFrame:
    """Add the load columns and the whole landed row as JSON.

    ``ingestion_id`` hashes run, file and row, so a re-run of the same load gives
    the same ids.
    """
    reserved = set(LOAD_COLUMNS) | {"raw_payload"}
    payload = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in reserved]))
    if "source_path" in df.columns:
        path = F.col("source_path")
    else:
        path = source_path if isinstance(source_path, Column) else F.lit(source_path)
    return df.withColumns({"source_path": path.cast("string"), "raw_payload": payload}).withColumns(
        {
            "source_system": F.lit(origin.source_system),
            "cloud_provider": F.lit(origin.cloud_provider),
            "collected_at": ts_lit(run_ts),
            "ingestion_id": hash_key(ts_lit(run_ts), "source_path", "raw_payload"),
        }
    )


def resource_raw(loaded: DataFrame) -> DataFrame:
    return loaded.select(*LOAD_COLUMNS, "raw_payload")


def _nested_schema(paths: list[str]) -> T.StructType:
    """Struct of text leaves that holds exactly the given dotted paths."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for part in parents:
            node = node.setdefault(part, {})
        node[leaf] = None

    def struct(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, T.StringType() if v is None else struct(v)) for k, v in node.items()])

    return struct(tree)


def flatten_resource(loaded: DataFrame) -> DataFrame:
    """The 41 flattened columns of a landed resource.

    ``properties`` is parsed once per row into the paths that are used, not once
    per path. Booleans and numbers come out as their JSON text.
    """
    parsed = F.from_json("properties", _nested_schema(list(PROPERTY_PATHS.values())))
    loaded = loaded.withColumn("__properties", parsed)
    return loaded.select(
        F.col("id").alias("resource_id"),
        F.col("name").alias("resource_name"),
        F.lower("type").alias("resource_type"),
        *[F.col(c) for c in ("subscription_id", "resource_group", "location", "kind")],
        F.col("sku.name").alias("sku_name"),
        F.col("sku.tier").alias("sku_tier"),
        F.to_json("tags").alias("tags_json"),
        F.col("properties").alias("properties_json"),
        *[F.col(f"__properties.{p}").alias(name) for name, p in PROPERTY_PATHS.items()],
        "source_path",
        "collected_at",
    )


def resource_tags(loaded: DataFrame) -> DataFrame:
    """One row per tag of each landed resource."""
    carry = [*LOAD_COLUMNS, F.col("id").alias("resource_id"), "subscription_id"]
    return explode_tags(loaded.filter(F.col("tags").isNotNull()), F.col("tags"), carry)


def cloud_accounts(loaded: DataFrame, run_ts, origin: Origin = Origin(), source_path: str | None = None) -> DataFrame:
    """Distinct subscriptions of a load."""
    return loaded.select("subscription_id").distinct().select(
        "subscription_id",
        hash_key(ts_lit(run_ts), "subscription_id").alias("ingestion_id"),
        F.lit(origin.source_system).alias("source_system"),
        F.lit(origin.cloud_provider).alias("cloud_provider"),
        F.lit(origin.account_type).alias("account_type"),
        ts_lit(run_ts).alias("collected_at"),
        F.lit(source_path).cast("string").alias("source_path"),
    )


def notice_bronze(landed: DataFrame, run_ts, origin: Origin = Origin(), per_file: bool = False) -> DataFrame:
    """The 20 columns of a raw notice.

    The id hashes vendor, day and title, so the same announcement on another
    ingest date is the same notice; ``per_file`` hashes the file as well and
    keeps them apart.
    """
    nothing = F.lit(None).cast("string")
    notice_id = hash_key("source_path", "created", "title") if per_file else hash_key(F.lit(origin.vendor), "created", "title")
    payload = F.to_json(F.struct(*landed.columns))
    return landed.select(
        hash_key(ts_lit(run_ts), "source_path", payload).alias("ingestion_id"),
        F.lit(origin.source_system).alias("source_system"),
        F.lit(origin.cloud_provider).alias("cloud_provider"),
        F.lit(origin.vendor).alias("vendor"),
        notice_id.alias("notice_id"),
        "title",
        nothing.alias("summary"),
        F.lit(origin.notice_service).alias("affected_service"),
        nothing.alias("affected_feature"),
        nothing.alias("affected_runtime"),
        nothing.alias("affected_version"),
        F.try_to_timestamp("retire_date").alias("retirement_at"),
        F.try_to_timestamp("created").alias("published_at"),
        nothing.alias("severity"),
        "status",
        "retire_date",
        F.col("retire_year").cast("long").alias("retire_year"),
        ts_lit(run_ts).alias("collected_at"),
        "source_path",
        payload.alias("raw_payload"),
    )
