"""Errors raised while a query or an index is being put together."""


class QueryError(ValueError):
    """A query refers to a clause, type or parent that does not exist."""


class PublishError(RuntimeError):
    """An index version cannot be created or made live."""
