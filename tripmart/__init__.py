"""Trip analytics as plain Spark DataFrames: staging, marts, anomaly flags, history and checks."""

from tripmart.schemas import LAKEHOUSE, WAREHOUSE, Profile

__all__ = ["LAKEHOUSE", "WAREHOUSE", "Profile"]
