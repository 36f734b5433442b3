"""Cut lineage with tables in the folder that all executors share (see assayer.sources.durable)."""

from ..sources.durable import discard, shared_folder, written

__all__ = ["discard", "shared_folder", "written"]
