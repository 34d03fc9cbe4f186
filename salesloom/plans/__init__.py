"""Analytical questions: dashboards, result tables, comparisons, problems and root causes."""
