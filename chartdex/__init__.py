"""chartdex: build and maintain patient-list search indexes with Spark DataFrames."""
