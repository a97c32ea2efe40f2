from ledgerwalk.sources.contracts import RAW_CONTRACTS, SOURCE_NAMES
from ledgerwalk.sources.extracts import read_extract, read_extracts, require_sources, Sources
from ledgerwalk.sources.binding import bind_driver_tables, BINDING_BAND_EDGES

__all__ = [
    "RAW_CONTRACTS", "SOURCE_NAMES", "read_extract", "read_extracts", "require_sources",
    "Sources", "bind_driver_tables", "BINDING_BAND_EDGES",
]
