"""Registered queries and the SQL that gives the same rows."""

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under a name, with its SQL if there is one."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
