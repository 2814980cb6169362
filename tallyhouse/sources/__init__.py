from tallyhouse.sources.extract import (  # noqa: F401
    batch,
    filter_day,
    incremental,
    incremental_by_change,
    is_empty,
    snapshot,
    with_audit,
)
from tallyhouse.sources.files import export_parquet, read_csv, reassign_ids  # noqa: F401
from tallyhouse.sources.jdbc import Split, read_jdbc  # noqa: F401
from tallyhouse.sources.layers import (  # noqa: F401
    LAYERS,
    drop_partition,
    layer_path,
    partition_values,
    read_layer,
    read_tables,
    sized_files,
)
