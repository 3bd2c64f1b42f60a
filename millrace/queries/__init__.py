"""Registered queries; importing this package fills the registry."""

from millrace.queries import (  # noqa: F401
    aggregates,
    feature_queries,
    ingest_queries,
    iterative_queries,
    job_chain,
    jobs,
    model_checks,
    model_queries,
    ordered_queries,
    relational,
    scalars,
    sink_queries,
    source_queries,
    stream_queries,
    summary_queries,
    udf_queries,
)
