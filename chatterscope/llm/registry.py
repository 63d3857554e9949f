"""The queries of this subpackage, each with the SQL that must give the same rows where there is one."""

QUERIES = {}
ORACLE = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load():
    """Import all modules that register queries."""
    from chatterscope.llm import queries, queries_more  # noqa: F401

    return QUERIES, ORACLE
