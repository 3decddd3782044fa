"""framewatch: frame telemetry quality gate, drift and incident analytics on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, windows, joins and higher-order functions.
"""

from .config import DEFAULT_CONFIG, FIXTURE_CONFIG, GateConfig

__all__ = ["GateConfig", "DEFAULT_CONFIG", "FIXTURE_CONFIG"]
