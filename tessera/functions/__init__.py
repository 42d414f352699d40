"""Column-expression building blocks (no Python per row).

Everything here returns a ``pyspark.sql.Column`` so it stays inside whole-stage
codegen and composes with any DataFrame.
"""
