"""Query registry (Spark side) and the independent SQL oracle texts."""
