"""Purchase-recommendation analytics on retail baskets, as lazy Spark DataFrames."""
