"""Scans, sinks and the driver-table adapter."""

from grimlake.sources.adapter import raw_from_driver
from grimlake.sources.raw import (land, preview, read_raw, register_view, save_as_table,
                                  write_csv, write_table)
from grimlake.sources.schemas import RAW_SCHEMAS

__all__ = ["raw_from_driver", "land", "preview", "read_raw", "register_view",
           "save_as_table", "write_csv", "write_table", "RAW_SCHEMAS"]
