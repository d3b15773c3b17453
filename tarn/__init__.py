"""tarn: lakehouse loading, modelling and maintenance operators on Spark DataFrames."""
