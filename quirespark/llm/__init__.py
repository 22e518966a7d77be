"""Operators of a training-data pipeline. Nothing outside this folder imports it.

``registry`` lists the queries and their SQL; each other module holds one
operator with its general interface.
"""
