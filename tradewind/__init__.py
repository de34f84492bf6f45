"""Retail analytics on Spark: cleaning, star schema, measures, audits and models."""
