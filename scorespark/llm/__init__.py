"""Operators of a training-data pipeline: each module builds one Spark plan over documents or pages."""
