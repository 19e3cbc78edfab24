from .measures import MEASURES, merge_exprs, partial_exprs, with_avg
from .times import as_text, bucket, bucket_name, days_between, literal, moment, time_range, today

__all__ = [
    "MEASURES",
    "as_text",
    "bucket",
    "bucket_name",
    "days_between",
    "literal",
    "merge_exprs",
    "moment",
    "partial_exprs",
    "time_range",
    "today",
    "with_avg",
]
