"""Operators for training-data pipelines over tables of documents and vectors.

Each module holds one operator; ``queries`` registers them over the driver's
tables. Nothing outside this folder imports it.
"""
