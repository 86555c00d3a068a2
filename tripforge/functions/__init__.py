"""Column-expression builders: rules, coercions, features, outlier predicates.

Everything here returns ``pyspark.sql.Column`` objects made of built-in
functions only, so they compile into whole-stage codegen with no Python
workers involved.
"""
