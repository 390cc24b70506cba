"""Whole plans: the warehouse build, the KPI reports over it, the same
reports computed from the sources, and their reconciliation."""
