"""Importing this package registers every model, in the order they build on each other."""

# isort: off
from ledgerlake.plans import staging  # noqa: F401
from ledgerlake.plans import outreach  # noqa: F401
from ledgerlake.plans import cashflow  # noqa: F401
from ledgerlake.plans import portfolio  # noqa: F401
from ledgerlake.plans import macro  # noqa: F401
from ledgerlake.plans import longhistory  # noqa: F401
from ledgerlake.plans import revenue  # noqa: F401
from ledgerlake.plans import review  # noqa: F401
