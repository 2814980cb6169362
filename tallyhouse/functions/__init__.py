from tallyhouse.functions.measures import (  # noqa: F401
    count_where,
    half_up,
    money,
    or_zero,
    sum_where,
    total,
)
from tallyhouse.functions.status import canonical, status_in, status_is  # noqa: F401
