"""Layered ladder analytics on Spark: landings, layered tables, ranking, profiles."""
