"""rangelake: numbered blocks in, query-ready range-partitioned tables out, on Spark."""
