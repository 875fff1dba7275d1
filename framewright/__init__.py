"""framewright: video, image and text corpus preparation on Spark."""
