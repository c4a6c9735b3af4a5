"""Customer segmentation and retail insight on Spark DataFrames."""
