"""Reporting tables, data checks, profiling reports and the warehouse build."""
