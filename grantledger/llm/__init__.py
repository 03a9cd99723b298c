"""Operators for preparing training text. Nothing else in the library imports this package.

Column names that begin with two underscores are the operators' own; tables
handed to them may have columns of any other name.
"""
