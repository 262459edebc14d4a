"""Table sources: the driver fixture mapping and Parquet/catalog layouts."""

from shoplens.sources.fixture import derive_tables  # noqa: F401
from shoplens.sources.tables import (  # noqa: F401
    bucket_skew,
    from_driver_dir,
    read_catalog_tables,
    read_parquet_tables,
    write_bucketed_tables,
    write_parquet_tables,
)
