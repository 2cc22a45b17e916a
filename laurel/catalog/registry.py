"""The list of registered queries."""

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional SQL text."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
