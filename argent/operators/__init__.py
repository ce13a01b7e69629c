from argent.operators.dedup import keep_one  # noqa: F401
from argent.operators.filters import all_of, greater_than, is_true, not_null  # noqa: F401
from argent.operators.joins import (  # noqa: F401
    fits_broadcast,
    lookup_join,
    rows_referenced_by,
    semi_join,
)
from argent.operators.nested import explode_rows  # noqa: F401
from argent.operators.sets import tagged, union_by_name  # noqa: F401
