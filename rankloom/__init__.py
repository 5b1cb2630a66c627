"""rankloom: ranking feeds to a star schema and a wide mart, on Spark."""
