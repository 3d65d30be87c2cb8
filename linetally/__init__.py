"""linetally: a PySpark library for profiling tables of categorised
transaction lines (text cleaning, per-text profile, Pareto selection,
filtered extracts and exports), built on DataFrame operations only."""

from .schema import LineColumns, UNDEFINED_CATEGORY, PARETO_SHARE

__all__ = ["LineColumns", "UNDEFINED_CATEGORY", "PARETO_SHARE"]
