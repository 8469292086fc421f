"""Build and maintain date-partitioned datamarts with Spark."""

from martloom.config import Lifetime, MartSpec, RunConfig
from martloom.session import build_session

__all__ = ["Lifetime", "MartSpec", "RunConfig", "build_session"]
