"""Corpus attribution analytics as Spark DataFrame operators.

Sub-packages
------------
``sources``    scans, hash-verified loads, report sinks, study JSON
``functions``  Column -> Column text and hashing expressions, n-gram kernel
``operators``  DataFrame -> DataFrame operators (splits, features, metrics, ...)
``plans``      end-to-end jobs and the query catalogue
``streaming``  incremental scoring over a file stream
"""

__version__ = "0.1.0"
