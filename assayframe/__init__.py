"""assayframe: the table work behind structure-activity modelling, on Spark.

Every operator is a plain function from DataFrame to DataFrame.
"""
