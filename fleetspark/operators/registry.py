"""Vehicle registry and fleets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.plans.paging import check_fleet, check_page, check_vehicle, page
from fleetspark.schema import VEHICLE


def registry_quality(registry: DataFrame) -> DataFrame:
    """Row count and exact distinct ids and VINs."""
    return registry.agg(
        F.count(F.lit(1)).alias("vehicles"),
        F.count_distinct("vehicle_id").alias("vehicle_ids"),
        F.count_distinct("vin").alias("vins"),
    )


def load_registry(spark: SparkSession, path: str, expected: int) -> DataFrame:
    """Registry CSV, refused unless it holds exactly `expected` unique vehicles."""
    rows = spark.read.schema(VEHICLE).csv(path, header=True, mode="FAILFAST")
    found = registry_quality(rows).first()
    if set(found) != {expected}:
        raise ValueError(f"registry must hold exactly {expected} unique vehicles, found {found}")
    return rows


def upsert_absent(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows plus the incoming ones whose key is new; existing rows win."""
    fresh = incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def registry_scan(registry: DataFrame, fleet_id: str | None = None) -> DataFrame:
    """All vehicles, or those of one fleet."""
    return registry if check_fleet(fleet_id) is None else registry.where(F.col("fleet_id") == fleet_id)


def registry_page(
    registry: DataFrame, limit: int = 25, offset: int = 0, fleet_id: str | None = None
) -> DataFrame:
    """One page in vehicle order (T4)."""
    check_page(limit, offset, 100)
    return page(registry_scan(registry, fleet_id), [F.asc("vehicle_id")], limit, offset)


def registry_total(registry: DataFrame, fleet_id: str | None = None) -> DataFrame:
    """Number of vehicles behind the pages."""
    return registry_scan(registry, fleet_id).agg(F.count(F.lit(1)).alias("total"))


def vehicle(registry: DataFrame, vehicle_id: str) -> DataFrame:
    """Point lookup."""
    return registry.where(F.col("vehicle_id") == check_vehicle(vehicle_id))


def known_vehicles(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows whose vehicle is registered."""
    return rows.join(registry.select("vehicle_id"), "vehicle_id", "left_semi")


def unknown_vehicles(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Vehicles that report without being registered.

    Reduced to one row per vehicle before the join, so a chatty vehicle is one row in it.
    """
    return rows.select("vehicle_id").distinct().join(
        registry.select("vehicle_id"), "vehicle_id", "left_anti"
    )


def fleet_orphans(registry: DataFrame, fleets: DataFrame) -> DataFrame:
    """Vehicles whose fleet does not exist; must be empty."""
    return registry.join(fleets.select("fleet_id"), "fleet_id", "left_anti").select(
        "vehicle_id", "fleet_id"
    )


def check_fleets(registry: DataFrame, fleets: DataFrame) -> None:
    if not fleet_orphans(registry, fleets).isEmpty():
        raise ValueError("registry refers to unknown fleets")
