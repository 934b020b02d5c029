"""Writers for batch results; streaming sinks are in ``tallyfold.streaming``."""
