"""postlens: social-media and news text analytics as Spark DataFrame jobs."""
