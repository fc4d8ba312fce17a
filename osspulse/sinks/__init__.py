"""Writers."""

from osspulse.sinks.contracts import ContractError, assert_contract, assert_same_schema
from osspulse.sinks.layers import Layer, catalog_marts, ensure_layers
from osspulse.sinks.staging_area import cut_lineage
from osspulse.sinks.tables import (
    KeyIndex,
    WriteGroup,
    finish_switches,
    in_partitions,
    merge_table,
    row_counts,
    snapshot_table,
    write_table,
)

__all__ = [
    "ContractError",
    "KeyIndex",
    "Layer",
    "WriteGroup",
    "assert_contract",
    "assert_same_schema",
    "catalog_marts",
    "cut_lineage",
    "ensure_layers",
    "finish_switches",
    "in_partitions",
    "merge_table",
    "row_counts",
    "snapshot_table",
    "write_table",
]
