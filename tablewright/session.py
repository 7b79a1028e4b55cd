"""Session building from named resource profiles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Resource profiles offered by name.
PROFILES: dict[str, dict[str, str]] = {
    "baseline": {
        "spark.driver.memory": "2g",
        "spark.executor.cores": "1",
        "spark.sql.shuffle.partitions": "10",
    },
    "low_resource": {
        "spark.driver.memory": "1g",
        "spark.executor.cores": "1",
        "spark.sql.shuffle.partitions": "5",
    },
    "more_cores": {
        "spark.driver.memory": "2g",
        "spark.executor.cores": "2",
        "spark.sql.shuffle.partitions": "20",
    },
    "high_parallelism": {
        "spark.driver.memory": "4g",
        "spark.executor.cores": "4",
        "spark.sql.shuffle.partitions": "50",
    },
}
DEFAULT_PROFILE = "more_cores"

# Applied under every profile: runtime re-planning, so that the partition count of a
# profile is a starting point and skewed shuffle partitions are split.
COMMON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def profile_settings(profile: str = DEFAULT_PROFILE, overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """Settings of a profile, with ``overrides`` winning over both profile and common values."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; choose one of {sorted(PROFILES)}")
    return {**COMMON, **PROFILES[profile], **(overrides or {})}


def build(
    profile: str = DEFAULT_PROFILE,
    app_name: str = "tablewright",
    master: str | None = None,
    overrides: Mapping[str, str] | None = None,
) -> SparkSession:
    """Start a session for a profile, or hand back the running one untouched.

    Memory and core settings only act before the JVM starts, and a session that someone else
    configured must keep its settings, so an active session is returned as it is.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in profile_settings(profile, overrides).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
