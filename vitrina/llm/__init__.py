"""Training-data pipeline operators.

Nothing else in the library imports this package; it may import the library's
general helpers.  Each module holds one operator with its own interface;
``queries.py`` registers the thin ``opN_<name>`` queries over the given tables.
"""
