"""Open-data harvesting as Spark jobs."""

from gleanspark.session import configure, local_session

__all__ = ["configure", "local_session"]
