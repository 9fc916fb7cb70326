"""slidemill: a PySpark-native engine for building image-dataset tables.

Operators are plain functions ``DataFrame -> DataFrame`` with column-name
parameters, composed from Spark SQL expressions wherever those suffice.
"""

__version__ = "0.1.0"
