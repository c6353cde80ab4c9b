"""tidemark: database change logs as Spark DataFrames and streams."""

from tidemark.schema import CHANGE_SCHEMA, ORDER, commit_order

__all__ = ["CHANGE_SCHEMA", "ORDER", "commit_order"]
