"""Training-data operators: ten corpus operators and the pipeline that chains five of them.

Nothing else in the library imports this subpackage.  Operators take DataFrames
and column names; ``queries.py`` holds the registered queries over the tables.
"""
