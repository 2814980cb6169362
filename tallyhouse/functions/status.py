"""Status text: raw tables hold mixed case, cleaned tables upper case.

Every comparison goes through the canonical form, so marts and rules give the
same answer on either layer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(status: Column | str) -> Column:
    status = F.col(status) if isinstance(status, str) else status
    return F.upper(F.trim(status.cast("string")))


def status_is(status: Column | str, name: str) -> Column:
    return canonical(status) == name.upper()


def status_in(status: Column | str, *names: str) -> Column:
    return canonical(status).isin([name.upper() for name in names])
