"""Normalisation of provider codes, tags, runtimes and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duskline.functions.text import first_label

# ---------------------------------------------------------------------------
# Region codes and their display names.
REGIONS = {
    "eastus": "East US",
    "eastus2": "East US 2",
    "westus": "West US",
    "westus2": "West US 2",
    "centralus": "Central US",
    "southcentralus": "South Central US",
    "northcentralus": "North Central US",
    "brazilsouth": "Brazil South",
    "eastasia": "East Asia",
    "southeastasia": "Southeast Asia",
    "westeurope": "West Europe",
    "northeurope": "North Europe",
    "uksouth": "UK South",
    "ukwest": "UK West",
    "australiaeast": "Australia East",
}
# Text found in an account name and the environment it means, in order.
ENVIRONMENT_MARKERS = (
    ("prod", "production"),
    ("dev", "development"),
    ("test", "testing"),
    ("stg", "staging"),
    ("staging", "staging"),
)
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def region_name(code: Column | str) -> Column:
    """Display name of a region code; an unknown code passes through unchanged."""
    code = _col(code)
    pairs = [F.lit(x) for item in REGIONS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(code)), code)


def account_environment(name: Column | str) -> Column:
    """Environment named inside an account name or id."""
    folded = F.lower(_col(name))
    return first_label([(folded.contains(m), label) for m, label in ENVIRONMENT_MARKERS], "unknown")


def tag_label(*candidates: Column | str) -> Column:
    """First tag present, folded and trimmed, else 'unknown'."""
    return F.lower(F.trim(F.coalesce(*[_col(c) for c in candidates], F.lit("unknown"))))


def runtime_parts(runtime: Column | str) -> tuple[Column, Column]:
    """(folded name, version) of a ``NAME|version`` text; the version is null when absent."""
    parts = F.split(_col(runtime), r"\|")
    return F.lower(F.get(parts, F.lit(0))), F.get(parts, F.lit(1))


def first_timestamp(*candidates: Column | str) -> Column:
    """First candidate that reads as a timestamp; unreadable text counts as missing."""
    return F.coalesce(*[_col(c).try_cast("timestamp") for c in candidates])
