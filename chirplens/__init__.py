"""Analytics over short social posts kept in tables, as Spark jobs."""
