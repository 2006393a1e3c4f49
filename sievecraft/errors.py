"""Errors raised when data or arguments cannot be processed safely."""


class DataQualityError(ValueError):
    """The data breaks a rule that a result depends on; the message carries the numbers."""
