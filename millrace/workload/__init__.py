"""The registered queries: every operator run over the test tables, with its equivalent SQL."""

from millrace.workload import checks, functions, incremental, relations, storage
from millrace.workload.registry import REGISTRY

__all__ = ["REGISTRY", "checks", "functions", "incremental", "relations", "storage"]
