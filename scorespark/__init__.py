"""Behavioural customer scoring over transaction tables, expressed as Spark plans.

Every operator takes and returns a ``DataFrame`` and is usable with
``DataFrame.transform``.  Nothing in the package calls a Python UDF.
"""

__version__ = "0.1.0"
