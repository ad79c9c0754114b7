"""Clickstream commerce analytics as Spark DataFrame transformations."""
