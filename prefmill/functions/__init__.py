"""Part of the preference-data engine."""
