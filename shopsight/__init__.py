"""shopsight: shop-event analytics on Spark DataFrames."""
