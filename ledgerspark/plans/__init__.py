from ledgerspark.plans.build import (
    MODELS,
    RunAllError,
    build,
    run,
    run_all,
    run_snapshot,
    select_models,
    snapshot_target,
    target_of,
)

__all__ = ["MODELS", "RunAllError", "build", "run", "run_all", "run_snapshot", "select_models", "snapshot_target",
           "target_of"]
