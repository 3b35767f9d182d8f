"""Errors with stable classes. All but InternalError are the user's to mend."""


class TesseraError(Exception):
    error_class = "ERROR"


class TypeConversionError(TesseraError):
    """Strict mode: a stored value does not fit its column."""

    error_class = "TYPE_CONVERSION_ERROR"


class NotReadOnlyError(TesseraError):
    """A passthrough query does, or could do, more than read ordinary collections."""

    error_class = "QUERY_NOT_READ_ONLY"


class SchemaError(TesseraError):
    """A table's schema cannot be established from its override document or its sample."""

    error_class = "SCHEMA_ERROR"


class NotFoundError(TesseraError):
    error_class = "NOT_FOUND"


class InvalidArgumentError(TesseraError):
    error_class = "INVALID_ARGUMENT"


class UnsupportedError(TesseraError):
    error_class = "UNSUPPORTED"


class InternalError(TesseraError):
    error_class = "INTERNAL"
