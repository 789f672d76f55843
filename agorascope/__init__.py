"""agorascope: analytics over discussion corpora, declared as Spark DataFrames."""
