"""cordon: a Spark-native audit of trip records against a road-pricing (cordon) policy.

Every operator is a plain ``DataFrame -> DataFrame`` function built on Spark's own expressions,
so Catalyst can prune, push down and fuse it. Nothing here triggers an action except the few
helpers that are documented to (size checks, sinks).
"""

from cordon.config import AuditConfig, DEFAULT_CONFIG, FIXTURE_CONFIG

__all__ = ["AuditConfig", "DEFAULT_CONFIG", "FIXTURE_CONFIG"]
