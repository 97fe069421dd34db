"""Error classes raised while a plan is being built, or by strict jobs."""


class DugoutError(Exception):
    """Base class."""


class InvalidParameter(DugoutError, ValueError):
    """An argument is outside what the operator accepts."""


class SchemaMismatch(DugoutError):
    """A table lacks required columns or holds values of the wrong type."""


class PayloadRejected(DugoutError):
    """A raw payload cannot be turned into rows."""


class MissingPartition(DugoutError):
    """A season was asked for that the dataset does not hold."""
