"""Survey analytics on Spark: harmonise yearly wide files, publish small marts."""
