"""Training-data operators: ten corpus-scale operators and the queries that apply them.

Nothing else in the library imports this subpackage. ``registry`` holds the
``opN_*`` queries and the SQL statements they are compared with.
"""
