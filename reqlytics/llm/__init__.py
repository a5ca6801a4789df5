"""Operators of a training-data pipeline: chat formatting, scans, tokens, classifiers, searches and joins.

``queries.py`` registers one query per operator, ``oracle.py`` holds the SQL for those that SQL can express.
"""
