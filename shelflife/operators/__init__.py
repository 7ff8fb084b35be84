"""DataFrame operators: ``f(tables, **params) -> DataFrame``.

``tables`` is any mapping from the nine model table names to DataFrames
(:class:`shelflife.tables.Tables`, a plain dict, or tables read from files).
"""
