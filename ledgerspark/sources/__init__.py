from ledgerspark.sources.catalog import SourceCatalog, qualified, table_name, target_namespace
from ledgerspark.sources.targets import (
    HistoryTarget,
    PartitionedTarget,
    RowLevelTarget,
    StaleRunError,
    TableTarget,
    buckets_for,
    full_refresh,
    shared_folder,
    write_table,
)

__all__ = ["HistoryTarget", "PartitionedTarget", "RowLevelTarget", "SourceCatalog", "StaleRunError",
           "TableTarget", "buckets_for", "full_refresh", "qualified", "shared_folder", "table_name", "target_namespace", "write_table"]
