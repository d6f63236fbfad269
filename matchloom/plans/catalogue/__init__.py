"""All registered queries, one module per family."""

from matchloom.plans.catalogue import aggregates, joins, models, ordered, reports, scalars, sources  # noqa: F401
