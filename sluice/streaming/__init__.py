from .landing import table_stream

__all__ = ["table_stream"]
