from tickfold.plans.backfill import backfill_means, page_readings
from tickfold.plans.incremental import RunReport, run_incremental

__all__ = ["RunReport", "backfill_means", "page_readings", "run_incremental"]
