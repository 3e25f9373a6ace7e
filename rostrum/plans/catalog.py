"""All registered queries."""

from rostrum.plans import (  # noqa: F401  (importing registers the queries)
    queries_ingest,
    queries_marts,
    queries_members,
    queries_queue,
    queries_runlog,
    queries_sinks,
    queries_streaming,
    queries_text,
)
from rostrum.plans.registry import oracle_sql, queries  # noqa: F401
