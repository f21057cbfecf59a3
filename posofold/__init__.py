"""Medication-instruction analytics on Spark: text in, coded and validated data out."""
