"""Landing readers, table sinks and the feeds derived from the driver tables."""
