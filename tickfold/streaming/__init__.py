from tickfold.streaming.count_window import (
    batch_step,
    count_window_step,
    read_runs,
    start_count_window,
)
from tickfold.streaming.page_stream import page_step, start_page_stream
from tickfold.streaming.stateful_runs import (
    read_stateful_runs,
    start_stateful_runs,
    stateful_runs,
)

__all__ = [
    "batch_step",
    "count_window_step",
    "page_step",
    "read_runs",
    "read_stateful_runs",
    "start_count_window",
    "start_page_stream",
    "start_stateful_runs",
    "stateful_runs",
]
