"""Import the input frames and then every module of queries, so that they register."""

from bindings import frames  # noqa: F401  isort: skip
from bindings import b_checks, b_dashboards, b_filters, b_history, b_match, b_plans  # noqa: F401
from bindings import b_reconcile, b_reports, b_sources, b_streaming, b_windows  # noqa: F401
