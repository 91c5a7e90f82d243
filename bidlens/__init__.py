"""Ad-auction exposure analytics on Spark DataFrames."""
