"""Preference-data analytics expressed as Spark DataFrame plans."""
