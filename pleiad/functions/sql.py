"""The engine's scalar functions for SQL text: temporary functions with SQL bodies, which Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .physics import MUON_MASS

#: name: (parameters, result, body).
FUNCTIONS = {
    "polar_angle": ("eta DOUBLE", "DOUBLE", "2 * atan(exp(-eta))"),
    "px": ("pt DOUBLE, phi DOUBLE", "DOUBLE", "abs(pt) * cos(phi)"),
    "py": ("pt DOUBLE, phi DOUBLE", "DOUBLE", "abs(pt) * sin(phi)"),
    "pz": ("pt DOUBLE, eta DOUBLE", "DOUBLE", "abs(pt) / tan(2 * atan(exp(-eta)))"),
    "energy": ("pt DOUBLE, eta DOUBLE, mass DOUBLE", "DOUBLE", "sqrt(pt * pt + pow(pt / tan(2 * atan(exp(-eta))), 2) + mass * mass)"),
    "muon_mass": ("", "DOUBLE", f"{MUON_MASS!r}D"),
    "bin_index": (
        "x DOUBLE, bins BIGINT, low DOUBLE, high DOUBLE",
        "BIGINT",
        "width_bucket(x, low, high, bins)",
    ),
    "column_name": ("name STRING", "STRING", "replace(replace(name, '.', '_'), '::', '__')"),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session; their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
