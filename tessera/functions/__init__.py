from .infer import infer_value, schema_of_documents
from .cells import materialize, mismatch, strict, with_offset
from .types import UNKNOWN, merge, parse_declared, settle

__all__ = ["UNKNOWN", "infer_value", "materialize", "merge", "mismatch", "parse_declared", "schema_of_documents", "settle", "strict", "with_offset"]
