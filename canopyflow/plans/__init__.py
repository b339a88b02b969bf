"""Registered queries: catalog, and areas beside it."""

from canopyflow.plans import areas  # noqa: F401  registers its queries
