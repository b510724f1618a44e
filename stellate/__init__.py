"""Star-schema batch analytics written as Spark DataFrame jobs.

Six related source tables are landed with declared schemas, checked, cleaned and
deduplicated, modelled as dimensions and two facts, and read through five marts.
"""
