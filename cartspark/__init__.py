"""Cart-abandonment analytics for shopping clickstreams on Spark."""
