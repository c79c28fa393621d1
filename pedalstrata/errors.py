"""Errors raised before or after a Spark job, never from inside a row."""


class DatasetError(RuntimeError):
    """The data cannot be processed: missing, empty, or below its contract."""
