"""Operators of a training-data pipeline, each built by the method its module names."""
