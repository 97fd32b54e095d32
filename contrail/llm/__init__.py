"""Operators of a training-data pipeline, each with its registered query.

One module per operator; ``registry`` collects the queries and their SQL. Nothing
else in the library imports this package.
"""
