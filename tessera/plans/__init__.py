"""Jobs: compositions of operators over the driver tables."""
