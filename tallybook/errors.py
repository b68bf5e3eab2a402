"""Typed failures; every one of them is raised before or instead of a result, never returned."""


class TallyError(Exception):
    """Base of all errors raised by this package."""


class ContractError(TallyError):
    """An input file lacks columns its service requires."""


class DuplicateKeyError(TallyError):
    """A join that must be one-to-one met a repeated key."""


class UnbalancedError(TallyError):
    """A result does not account for every input row."""


class UnknownServiceError(TallyError):
    """No configuration exists for the requested service or option."""
