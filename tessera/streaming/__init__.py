from .materialize import typed_stream

__all__ = ["typed_stream"]
