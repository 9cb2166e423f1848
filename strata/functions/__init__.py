"""Column functions: pure expressions over columns, all inside codegen."""

from strata.functions.hashing import business_columns, row_hash
from strata.functions.ingest import epoch_batch_id, hour_path, with_ingest_metadata
from strata.functions.measures import ltv_segment, percent_of
from strata.functions.stamps import epoch_micros, from_epoch_seconds, moment
from strata.functions.urls import query_params

__all__ = [
    "business_columns",
    "epoch_batch_id",
    "epoch_micros",
    "from_epoch_seconds",
    "hour_path",
    "ltv_segment",
    "moment",
    "percent_of",
    "query_params",
    "row_hash",
    "with_ingest_metadata",
]
