"""Operators for preparing large text corpora (training data) on Spark.

Each module holds one operator with its general interface; ``queries.py``
registers one driver query per operator.
"""
