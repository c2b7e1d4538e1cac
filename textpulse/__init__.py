"""textpulse: sentiment scoring and analytics for social text, on Spark DataFrames."""
