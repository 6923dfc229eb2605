"""Errors a job stops on."""


class TripmillError(Exception):
    """Base of the errors below."""


class MissingInputError(TripmillError):
    """An input path is absent or holds no data files."""


class SchemaConflictError(TripmillError):
    """The part files of one directory have a column in types that do not go together."""


class QualityError(TripmillError):
    """A validation rule does not hold."""


class ConstraintError(TripmillError):
    """A key constraint of the warehouse does not hold."""


class ConflictError(TripmillError):
    """Another job has replaced the table that this one was about to replace."""
