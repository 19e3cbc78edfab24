from ..plans.rejects import ErrorBudgetExceeded, create_quarantine
from .control import History, StreamJob
from .jobs import compact_stream_rollup, rollup_batches, stream_dim, stream_raw, stream_rollup
from .windowed import stream_rollup_bounded

__all__ = [
    "ErrorBudgetExceeded",
    "History",
    "StreamJob",
    "compact_stream_rollup",
    "create_quarantine",
    "rollup_batches",
    "stream_dim",
    "stream_raw",
    "stream_rollup",
    "stream_rollup_bounded",
]
