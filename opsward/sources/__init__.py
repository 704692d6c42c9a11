from .access import ACCESS_PATHS, Access, open_access, write_access
from .layers import Layers, layout, load_raw, preview, read_raw, refresh_stats, row_counts, upsert

__all__ = [
    "ACCESS_PATHS", "Access", "open_access", "write_access",
    "Layers", "layout", "load_raw", "preview", "read_raw", "refresh_stats", "row_counts", "upsert",
]
