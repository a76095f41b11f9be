"""Trade-flow analytics on Spark: loading, lookups, flow cubes and the tables drawn from them."""
