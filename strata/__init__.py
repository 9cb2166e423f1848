"""strata: layered analytics tables (bronze, silver, gold) on plain PySpark.

Every public function takes and returns DataFrames; Catalyst picks the physical
plan.  Writers are thin wrappers over ``DataFrame.write``.
"""
