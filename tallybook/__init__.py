"""Payment reconciliation on Spark: lazy DataFrame operators and the plans built from them."""

from tallybook.errors import (
    ContractError,
    DuplicateKeyError,
    TallyError,
    UnknownServiceError,
)
from tallybook.session import build_session

__all__ = [
    "ContractError",
    "DuplicateKeyError",
    "TallyError",
    "UnknownServiceError",
    "build_session",
]
