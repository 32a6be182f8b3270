"""Layered trip tables on Spark: landing files -> bronze -> silver -> gold.

The package only declares DataFrame and SQL plans. Subpackages:

``contracts``   what a table must look like
``functions``   column expressions (casts, period from a path)
``sources``     landing files, catalog tables
``operators``   conform, unify, means, layer writes, materialise, export, validate
``plans``       whole steps (bronze, silver, gold) and the taxi configuration
"""
