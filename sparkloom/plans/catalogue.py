"""All registered queries."""

from sparkloom.plans import batch_queries, state_queries, storage_queries, stream_queries  # noqa: F401  (registers)
from sparkloom.plans.registry import QUERIES, SQL  # noqa: F401
