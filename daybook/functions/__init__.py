"""Column expressions shared by the operators (all JVM-side built-ins)."""

from daybook.functions.columns import (
    day_name, layout_columns, parse_event_time, process_date_from_layout,
)
from daybook.functions.draws import draw
from daybook.functions.exact import (
    exact_part, part_list, part_sum, summable, with_double, with_rest,
)

__all__ = ["day_name", "layout_columns", "parse_event_time", "process_date_from_layout", "draw",
           "exact_part", "part_list", "part_sum", "summable", "with_double", "with_rest"]
