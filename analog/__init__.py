"""The pipeline on the given star-schema tables.

There are no taxi files here, so ``lineitem`` stands for one kind of trip and ``events`` for
the other: all rows of both, staged as monthly drops and taken through every layer.
"""
