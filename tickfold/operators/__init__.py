from tickfold.operators.gates import mark_due, min_batch_gate, release_gate
from tickfold.operators.pages import assign_pages, known_pages, page_counts
from tickfold.operators.runs import (
    chunk_groups,
    chunk_index,
    chunk_mean,
    chunk_tail,
    max_chunks,
    mean_per_ten,
    page_mean,
    run_means,
    sensor_arrays,
    wide_chunk_index,
)
from tickfold.operators.shape import (
    drop_bad_cells,
    mark_readings,
    mark_sink_rows,
    sink_shape,
    split_marked,
    typed_readings,
)
from tickfold.operators.unpivot import (
    pack_cells,
    row_arrays,
    unpivot_map,
    unpivot_packed,
    unpivot_static,
)

__all__ = [
    "assign_pages",
    "chunk_groups",
    "chunk_index",
    "chunk_mean",
    "chunk_tail",
    "drop_bad_cells",
    "known_pages",
    "mark_due",
    "mark_readings",
    "mark_sink_rows",
    "max_chunks",
    "mean_per_ten",
    "min_batch_gate",
    "pack_cells",
    "page_counts",
    "page_mean",
    "release_gate",
    "row_arrays",
    "run_means",
    "sensor_arrays",
    "sink_shape",
    "split_marked",
    "typed_readings",
    "unpivot_map",
    "unpivot_packed",
    "unpivot_static",
    "wide_chunk_index",
]
