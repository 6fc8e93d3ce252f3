"""veriframe: data-quality checks, profiles and anomalies as Spark DataFrames."""
